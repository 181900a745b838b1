"""roadsight — road-checkpoint traffic analytics on Spark.

Every operator takes DataFrames and returns a DataFrame; batch and
Structured Streaming share the same column expressions.  See README.md.
"""

from roadsight.session import get_spark, scratch_dir  # noqa: F401

__all__ = ["get_spark", "scratch_dir"]
