"""Global row numbering without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadsight.session import checkpoint_root


def global_index(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Add ``_gidx`` (1-based position in the total order of ``order``) and
    ``_total`` (row count of ``df``).

    Range-partition by the order key, sort inside partitions, count rows per
    partition and add the running count of the earlier partitions.  The
    range-partitioned data is checkpointed (reliable storage under
    ``spark.checkpoint.dir``) so that partition boundaries and in-partition
    ids cannot change if a task is recomputed after an executor loss.  The
    offset table has one row per partition, so broadcasting it is bounded.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("_total"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn("_gidx", F.col("_off") + local + F.lit(1))
                  .drop("_pid", "_mid", "_off"))


def count_window(df: DataFrame, size: int, order: Sequence[str], emit_partial: bool = False) -> DataFrame:
    """Consecutive groups of ``size`` rows in ``order`` (``batch_id`` from 0).

    With ``emit_partial=False`` an incomplete last group is not emitted
    (a count window that never fires).
    """
    out = global_index(df, order)
    out = out.withColumn("batch_id", F.call_function("div", F.col("_gidx") - 1, F.lit(size)))
    if not emit_partial:
        full = F.call_function("div", F.col("_total"), F.lit(size)) * F.lit(size)
        out = out.filter(F.col("_gidx") <= full)
    return out.drop("_gidx", "_total")
