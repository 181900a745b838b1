"""What a micro-batch was run with, kept under its batch id, so that a second run repeats the first.

Spark runs a micro-batch again when it was not committed: same rows, same id.  Whatever a batch
took from outside its rows (a time, a version, a position) is noted here before its output is
written, and read back when the id comes again.  An entry is one empty folder whose name holds the
numbers; making a folder is atomic on the file systems that can hold a query's checkpoint.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class BatchLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, name: str):
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(sc._jsc.hadoopConfiguration()), path

    def entries(self) -> list[tuple[int, ...]]:
        """(batch, numbers...) of all noted batches, in order."""
        fs, path = self._folder("")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(tuple(map(int, n.split("_"))) for n in names)

    def note(self, batch_id: int, *numbers: int) -> None:
        fs, path = self._folder("_".join(map(str, (batch_id, *numbers))))
        fs.mkdirs(path)

    def forget(self, entry: tuple[int, ...]) -> None:
        fs, path = self._folder("_".join(map(str, entry)))
        fs.delete(path, True)

    def before(self, batch_id: int) -> tuple[tuple[int, ...] | None, tuple[int, ...] | None]:
        """The entry of this batch, if it ran before, and the last entry of an earlier batch."""
        entries = self.entries()
        own = [e for e in entries if e[0] == batch_id]
        earlier = [e for e in entries if e[0] < batch_id]
        return (own[-1] if own else None), (earlier[-1] if earlier else None)
