"""Streams joined with dimensions that are reloaded on a schedule.

A plain stream-static join re-reads the static side in every micro-batch.
When the dimension lives in an external database and should only be polled
now and then (the source jobs reload hourly), ``RefreshingDimension`` keeps
the last load persisted and reloads it inside ``foreachBatch`` once it is
older than ``refresh_seconds``.  Rows of the new load win per key; keys that
vanished from the source keep their last row (``latest_by_key`` over the
previous and the new load).  Each load is checkpointed.

``VersionedDimension`` keeps its loads in a folder beside the query's checkpoint, one
version a load, and notes for every micro-batch which version it used.  A restarted
query so goes on with the keys of all earlier loads, and a batch that is run again
joins the same version as the first time.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsight.operators import speed, watchlist
from roadsight.session import checkpoint_root
from roadsight.sources.dims import latest_by_key
from roadsight.streaming.ledger import BatchLedger


class RefreshingDimension:
    def __init__(self, loader: Callable[[], DataFrame], key: str, refresh_seconds: float = 3600,
                 clock: Callable[[], float] = time.monotonic):
        self.loader, self.key, self.refresh_seconds, self.clock = loader, key, refresh_seconds, clock
        self.current: DataFrame | None = None
        self.loaded_at: float | None = None
        self.loads = 0

    def get(self) -> DataFrame:
        now = self.clock()
        if self.current is None or now - self.loaded_at >= self.refresh_seconds:
            self.loads += 1
            fresh = self.loader().withColumn("_load", F.lit(self.loads))
            merged = fresh if self.current is None else self.current.unionByName(fresh)
            # Reliable checkpoint under spark.checkpoint.dir: cuts the growing
            # chain of loads, and a lost executor cannot make the dimension
            # be recomputed from a later state of the source.
            checkpoint_root(merged.sparkSession)
            self.current = latest_by_key(merged, self.key, "_load").checkpoint(eager=True)
            self.loaded_at = now
        return self.current.drop("_load")


class VersionedDimension:
    """A dimension in versions below the folder ``path`` (shared storage), for a query's micro-batches.

    ``loads/<version>`` is a version's rows; a ledger says which version a batch joined and when it
    was loaded.  A version is written whole before a batch names it; one without a naming batch is
    left over from a crash and written again.  The last ``keep`` batches' versions are kept.
    """

    def __init__(self, spark: SparkSession, path: str, loader: Callable[[], DataFrame], key: str | list[str],
                 refresh_seconds: float = 3600, clock: Callable[[], float] = time.time, keep: int = 100):
        self.spark, self.path, self.loader, self.key = spark, path.rstrip("/"), loader, key
        self.refresh_seconds, self.clock, self.keep = refresh_seconds, clock, keep
        self.uses, self.loads = BatchLedger(spark, f"{self.path}/uses"), BatchLedger(spark, f"{self.path}/loads")

    def _read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/loads/{version}")

    def for_batch(self, batch_id: int) -> DataFrame:
        """The rows that micro-batch ``batch_id`` joins: one a key, the last load's where it has the key."""
        own, last = self.uses.before(batch_id)
        if own is None:
            now = int(self.clock() * 1000)
            if last is not None and now - last[2] < self.refresh_seconds * 1000:
                own = (batch_id, *last[1:])
            else:
                own = (batch_id, batch_id, now)
                fresh = self.loader().withColumn("_load", F.lit(batch_id).cast("long"))
                rows = fresh if last is None else self._read(last[1]).unionByName(fresh)
                latest_by_key(rows, self.key, "_load").write.mode("overwrite").parquet(f"{self.path}/loads/{batch_id}")
            self.uses.note(*own)
            self._forget()
        return self._read(own[1]).drop("_load")

    def _forget(self) -> None:
        uses = self.uses.entries()
        kept = {use[1] for use in uses[-self.keep:]}
        for use in uses[:-self.keep]:
            self.uses.forget(use)
            if use[1] not in kept:
                self.loads.forget((use[1],))


def join_with_refreshing_dimension(stream: DataFrame, dim: RefreshingDimension | VersionedDimension,
                                   transform: Callable[[DataFrame, DataFrame], DataFrame],
                                   sink: Callable[[DataFrame, int], None], checkpoint: str, **trigger):
    """Run ``transform(batch, dimension)`` per micro-batch and hand the result
    to ``sink(df, batch_id)``; returns the started query."""
    def each(batch: DataFrame, batch_id: int) -> None:
        rows = dim.for_batch(batch_id) if isinstance(dim, VersionedDimension) else dim.get()
        sink(transform(batch, rows), batch_id)
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def out_of_speed_refreshed(traffic: DataFrame, limits: VersionedDimension, sink: Callable[[DataFrame, int], None],
                           checkpoint: str, ratio: float = 1.1, **trigger):
    """Over-limit passes against limits that are loaded again while the stream runs."""
    return join_with_refreshing_dimension(traffic, limits, lambda batch, rows: speed.out_of_speed(batch, rows, ratio),
                                          sink, checkpoint, **trigger)


def track_listed_cars_refreshed(traffic: DataFrame, watch: VersionedDimension, sink: Callable[[DataFrame, int], None],
                                checkpoint: str, **trigger):
    """Track rows of listed cars against a watch list that is loaded again while the stream runs."""
    def tracks(batch: DataFrame, rows: DataFrame) -> DataFrame:
        return watchlist.with_row_key(watchlist.to_track(watchlist.listed_passes(batch, rows)))
    return join_with_refreshing_dimension(traffic, watch, tracks, sink, checkpoint, **trigger)
