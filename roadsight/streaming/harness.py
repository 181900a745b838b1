"""Replay bounded tables as streams and run a streaming query to completion.

``replay`` writes a table as time-ordered slices (the same number of files a slice,
slices written in time order, so the file source's modification-time order is
event-time order) plus one far-future *sentinel* row that moves the watermark past
every real row; ``maxFilesPerTrigger`` makes each slice one micro-batch, which is
written and read by as many tasks as it has files.
The sentinel must pass every filter of the query under test (Catalyst pushes
filters that do not touch the event-time column below the watermark node, so
a filtered-out sentinel would never reach it).  ``run_to_table`` runs a query with ``Trigger.AvailableNow`` into a parquet
sink (file sink with a commit log, exactly-once) under the checkpoint root and
returns the sink read back as a batch DataFrame — nothing passes through the
driver.

This harness stands in for Kafka in tests and benches; production code
points the same operators at ``stream_traffic(spark, "kafka", ...)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsight.session import scratch_dir

SENTINEL = "__flush__"
SENTINEL_DELAY_MS = 24 * 3600 * 1000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HDFS_BACKED = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def _state_store(spark: SparkSession, rocksdb: bool) -> None:
    """Pick the state store of the next query explicitly (the setting is
    per session).  RocksDB keeps large state off the JVM heap, is required by
    ``transformWithState`` and measured no slower here for small state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   ROCKSDB if rocksdb else HDFS_BACKED)


def replay(df: DataFrame, ts: str, name: str, slices: int = 6, sentinel: dict | None = None,
           fmt: str = "parquet", path: str | None = None) -> tuple[str, DataFrame]:
    """Write ``df`` as ``slices`` time slices (+ sentinel) into a fresh folder, or behind
    what an earlier replay wrote to the folder ``path``.

    ``sentinel`` gives column values for the flush row (its ``ts`` is set one
    day after the last row).  Returns ``(folder, streaming DataFrame)``.

    Every slice has the same number of files, at most the session's parallelism:
    rows are dealt round-robin, and a source partition that holds as many rows as
    there are files reaches each of them.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, f"stream-{name}")
    bounds = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    lo, hi = bounds.lo, bounds.hi
    width = max((hi - lo + 1) // slices + 1, 1)
    sl = df.withColumn("_slice", F.call_function("div", F.col(ts) - F.lit(lo), F.lit(width)))
    most = (sl.groupBy("_slice", F.spark_partition_id().alias("_p")).count()
              .groupBy("_slice").agg(F.max("count").alias("most")).orderBy("_slice").collect())  # a row a slice
    files = max(1, min(spark.sparkContext.defaultParallelism, *(r.most for r in most)))
    writer_cols = df.columns  # text replay writes only the ``value`` column
    for r in most:
        part = sl.filter(F.col("_slice") == r["_slice"]).select(*writer_cols).repartition(files)
        _write(part, path, fmt)
    if sentinel is not None:
        row = {c: None for c in writer_cols}
        row.update(sentinel)
        row[ts] = hi + SENTINEL_DELAY_MS
        flush = spark.createDataFrame([tuple(row[c] for c in writer_cols)], df.schema).coalesce(1)
        _write(flush, path, fmt)
    reader = spark.readStream.option("maxFilesPerTrigger", files)
    if fmt == "text":
        return path, reader.text(path)
    return path, reader.schema(df.schema).parquet(path)


def _write(part: DataFrame, path: str, fmt: str) -> None:
    if fmt == "text":
        part.select("value").write.mode("append").text(path)
    else:
        part.write.mode("append").parquet(path)


class _StreamingConf:
    """Session settings for one synchronous replay query, restored after it.

    State partitions of a streaming query are fixed at its first batch from
    ``spark.sql.shuffle.partitions`` (AQE does not coalesce them); the replay
    uses the session's default parallelism (total cores) instead of a batch
    default such as 200, so no micro-batch runs hundreds of near-empty
    state-store tasks."""

    def __init__(self, spark: SparkSession, rocksdb: bool):
        self.spark, self.rocksdb = spark, rocksdb

    def __enter__(self):
        conf = self.spark.conf
        changelog = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
        keys = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass", changelog]
        self.saved = {k: conf.get(k, None) for k in keys}
        conf.set("spark.sql.shuffle.partitions", str(self.spark.sparkContext.defaultParallelism))
        conf.set(changelog, "true")  # a batch uploads its changes, not the whole store
        _state_store(self.spark, self.rocksdb)
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def run_to_table(stream: DataFrame, name: str, output_mode: str = "append",
                 rocksdb: bool = True) -> DataFrame:
    """Run ``stream`` with AvailableNow into a parquet sink; return the sink."""
    spark: SparkSession = stream.sparkSession
    out = scratch_dir(spark, f"sink-{name}")
    with _StreamingConf(spark, rocksdb):
        q = (stream.writeStream.format("parquet").option("path", out + "/data")
                   .option("checkpointLocation", out + "/checkpoint")
                   .outputMode(output_mode).trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out + "/data")


def not_sentinel(df: DataFrame, col: str = "car") -> DataFrame:
    return df.filter(F.col(col) != F.lit(SENTINEL))


def run_updates_to_table(stream: DataFrame, name: str, rocksdb: bool = True) -> DataFrame:
    """Run an update-mode ``stream`` with AvailableNow; every emitted update
    is appended with its micro-batch id (``_batch``) to a parquet table,
    which is returned (a change log: the last update per key is the state)."""
    spark: SparkSession = stream.sparkSession
    out = scratch_dir(spark, f"updates-{name}")

    def each(batch: DataFrame, batch_id: int) -> None:
        # idempotent per batch id: a retried batch overwrites its own folder
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite") \
             .parquet(f"{out}/data/_batch_id={batch_id}")

    with _StreamingConf(spark, rocksdb):
        q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", out + "/checkpoint")
                   .outputMode("update").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out + "/data").drop("_batch_id")
