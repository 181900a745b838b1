"""Work on whole micro-batches that spans them: arrival stamps, late rows, count windows.

Each function makes a ``foreachBatch`` body.  What one batch hands to the next (a position, a
carried tail, the largest time seen) is stored under its batch id (:class:`BatchLedger`), so a
batch that runs again starts from the same place and replaces its own output.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsight.plans.numbering import global_index
from roadsight.streaming.ledger import BatchLedger

Body = Callable[[DataFrame, int], None]


def batch_folders(path: str) -> Body:
    """A sink of one folder a micro-batch below ``path``: a batch that runs again replaces its own."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")
    return write


def run_batches(stream: DataFrame, body: Body, checkpoint: str, **trigger):
    """Start ``body`` on every micro-batch of ``stream``."""
    writer = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def stamp_arrivals(spark: SparkSession, path: str, clock: Callable[[], float] = time.time) -> Body:
    """Store every micro-batch below ``path/data`` with the time it arrived (``arrival_time``, epoch ms).

    The time is taken once a batch and noted before the rows are written, and never runs backwards.
    Windows over the stored column are windows by ingestion time that a restart or a second
    run of the reading query cannot move.
    """
    ledger, write = BatchLedger(spark, f"{path}/arrivals"), batch_folders(f"{path}/data")

    def body(rows: DataFrame, batch_id: int) -> None:
        own, last = ledger.before(batch_id)
        if own is None:
            own = (batch_id, max(int(clock() * 1000), last[1] if last else 0))
            ledger.note(*own)
        write(rows.withColumn("arrival_time", F.lit(own[1]).cast("long")), batch_id)
    return body


def split_late(spark: SparkSession, path: str, on_time: Body, late: Body, ts: str = "action_time",
               delay_ms: int = 5_000) -> Body:
    """Send a batch's rows on in time or aside: late rows leave before an operator with state drops them.

    The watermark of a batch is the largest time of the batches before it less ``delay_ms``, as the
    state of a query over the same batches sees it; rows at or before it are late.  Rows without time go
    with those in time.  Both outputs together are the input.
    """
    ledger = BatchLedger(spark, f"{path}/watermarks")

    def body(rows: DataFrame, batch_id: int) -> None:
        own, last = ledger.before(batch_id)
        if own is None:  # (batch, watermark it is judged by or none, largest time up to its end)
            most = rows.agg(F.max(ts)).first()[0]
            seen = [x for x in ([last[2]] if last and last[3] else []) + ([most] if most is not None else [])]
            own = (batch_id, last[2] - delay_ms if last and last[3] else 0, max(seen, default=0), int(bool(seen)),
                   int(bool(last and last[3])))
            ledger.note(*own)
        is_late = F.lit(False) if not own[4] else F.coalesce(F.col(ts) <= F.lit(own[1]), F.lit(False))
        on_time(rows.where(~is_late), batch_id)
        late(rows.where(is_late), batch_id)
    return body


def count_windows(spark: SparkSession, path: str, size: int, order: list[str], write: Body) -> Body:
    """Groups of ``size`` rows in arrival order, over the borders of micro-batches (``batch_id`` from 0).

    Within a batch rows are ordered by ``order``.  A batch writes the groups that it completes; the rows
    behind the last full group, fewer than ``size``, are kept for the next batch below ``path/tails``.
    """
    ledger = BatchLedger(spark, f"{path}/positions")

    def body(rows: DataFrame, batch_id: int) -> None:
        _, last = ledger.before(batch_id)
        groups, tail = (last[1], last[2]) if last else (0, 0)
        numbered = global_index(rows, order).withColumn("_gidx", F.col("_gidx") + F.lit(tail)).drop("_total")
        n = tail + rows.count()
        if tail:
            numbered = spark.read.parquet(f"{path}/tails/{last[0]}").unionByName(numbered)
        full = n // size
        group = F.call_function("div", F.col("_gidx") - 1, F.lit(size))
        write(numbered.where(F.col("_gidx") <= full * size).withColumn("batch_id", group + F.lit(groups)).drop("_gidx"), batch_id)
        rest = numbered.where(F.col("_gidx") > full * size).withColumn("_gidx", F.col("_gidx") - F.lit(full * size))
        rest.coalesce(1).write.mode("overwrite").parquet(f"{path}/tails/{batch_id}")  # fewer rows than a group
        if ledger.before(batch_id)[0] is None:
            ledger.note(batch_id, groups + full, n - full * size)
        for old in ledger.entries()[:-100]:
            ledger.forget(old)
    return body
