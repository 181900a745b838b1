import subprocess
import sys


def test_entry_imports_without_the_optional_folder():
    code = ("import sys; sys.modules['roadsight.llm'] = None; import __spark_entry__ as e; "
            "assert 'out_of_speed' in e.queries() and 'pipeline' not in e.queries()")
    root = __file__.rsplit("/tests/", 1)[0]
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
