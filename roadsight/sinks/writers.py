"""Writers for results.

* JDBC appends use Spark's JDBC writer (``batchsize`` rows per round trip,
  one connection per task); streams reach them through ``foreachBatch``,
  whose batch id makes a retried micro-batch detectable.
* The daily violation table is a parquet table partitioned by ``day``;
  an upsert rewrites only the days present in the new reports (dynamic
  partition overwrite), after the merged result was checkpointed so the
  overwrite never reads the files it replaces.
* The track table is keyed by ``row_key``: writes are appends of sorted,
  range-partitioned files; readers keep the newest write per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsight.operators.danger import daily_violation_upsert
from roadsight.operators.watchlist import with_row_key
from roadsight.session import checkpoint_root
from roadsight.sources.dims import latest_by_key

SPEEDING_TABLE_COLUMNS = ["car", "monitor_id", "road_id", "real_speed", "limit_speed", "action_time"]
#: Files that a day is written to, so that no day passes through one task.
DAY_FILES = 8
DAILY_SCHEMA = "car string, violation string, create_time long, out_count int, day date"
AVERAGE_SPEED_TABLE_COLUMNS = ["start_time", "end_time", "monitor_id", "avg_speed", "car_count"]
VIOLATION_TABLE_COLUMNS = ["car", "violation", "create_time"]


def write_jdbc(df: DataFrame, url: str, table: str, columns: list[str] | None = None,
               mode: str = "append", batchsize: int = 1000, **props) -> None:
    """Append (or overwrite) ``df`` into a JDBC table."""
    out = df.select(*columns) if columns else df
    w = out.write.format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", batchsize)
    for k, v in props.items():
        w = w.option(k, v)
    w.mode(mode).save()


def write_jdbc_stream(stream: DataFrame, url: str, table: str, checkpoint: str,
                      columns: list[str] | None = None, **props):
    """Start a streaming append into a JDBC table (one JDBC write per micro-batch)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(batch, url, table, columns, "append", **props)
    return (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
                  .outputMode("append").start())


def upsert_daily_violations(new: DataFrame, path: str) -> DataFrame:
    """Merge violation reports into the day-partitioned table at ``path``.

    Only the days present in ``new`` are read back (the range of its days prunes
    partitions, a null-safe semi join picks the days) and rewritten; reports
    without time live in the partition of the null day.  A table that is not
    there yet is a first write; any other read error is raised, so stored rows
    are never overwritten by a failed read.  Returns the table.
    """
    spark = new.sparkSession
    day = F.date_from_unix_date(F.call_function("div", F.col("create_time"),
                                                F.lit(86_400_000)).cast("int"))
    new = new.select("car", "violation", "create_time", "out_count")
    if _table_exists(spark, path):
        existing = spark.read.schema(DAILY_SCHEMA).parquet(path)
        days = new.select(day.alias("_day")).distinct()
        lo, hi = days.agg(F.min("_day"), F.max("_day")).first()
        in_range = F.col("day").isNull() if lo is None else F.col("day").isNull() | F.col("day").between(F.lit(lo), F.lit(hi))
        touched = (existing.where(in_range).join(days, F.col("day").eqNullSafe(F.col("_day")), "left_semi").drop("day"))
    else:
        touched = new.limit(0)
    checkpoint_root(spark)
    merged = daily_violation_upsert(new, touched).checkpoint(eager=True)
    (merged.repartition(F.col("day"), F.pmod(F.xxhash64("car"), F.lit(DAY_FILES))).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))
    return spark.read.schema(DAILY_SCHEMA).parquet(path)


def _table_exists(spark: SparkSession, path: str) -> bool:
    """Whether data files are at ``path``, asked of the path's own file system."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(sc._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop)) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hadoop))


def write_tracks(tracks: DataFrame, path: str, partitions: int | None = None) -> None:
    """Append track rows to the keyed table (``row_key`` range-partitioned
    and sorted inside files, so key lookups and prefix scans prune files)."""
    keyed = with_row_key(tracks)
    if "seq" not in keyed.columns:
        keyed = keyed.withColumn("seq", F.lit(None).cast("long"))
    keyed = keyed.withColumn("write_ts", F.current_timestamp())
    n = partitions or int(tracks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (keyed.repartitionByRange(n, "row_key").sortWithinPartitions("row_key")
          .write.mode("append").parquet(path))


def read_tracks(spark: SparkSession, path: str, car: str | None = None) -> DataFrame:
    """Current state of the keyed table: the newest write per ``row_key``
    (optionally one car: ``row_key`` prefix, pushed to the parquet scan)."""
    t = spark.read.parquet(path)
    if car is not None:
        t = t.filter(F.col("row_key").startswith(car + "_"))
    order = F.struct("write_ts", "seq")
    return (latest_by_key(t.withColumn("_o", order).drop("write_ts", "seq"), "row_key", "_o")
            .drop("_o"))


def alert_console(stream: DataFrame, column: str = "alert_text", truncate: bool = False):
    """Print alert lines of a stream (the source jobs' ``print`` sinks)."""
    return (stream.select(column).writeStream.format("console")
                  .option("truncate", str(truncate).lower()).outputMode("append").start())


def upsert_daily_violations_stream(stream: DataFrame, path: str, checkpoint: str):
    """Streaming daily upsert: each micro-batch is merged into the
    day-partitioned table (read-merge-write of the touched days only)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        upsert_daily_violations(batch, path)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
