"""Watch lists and vehicle tracks (J3, P2–P4, F4, F6, K5 shape, X3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadsight.functions.exprs import track_row_key
from roadsight.plans.joins import bounded_broadcast
from roadsight.plans.numbering import count_window
from roadsight.plans.sequence import with_seq
from roadsight.schemas import TRACK_COLUMNS
from roadsight.sources.dims import latest_by_key

SUSPECTED_CLONE = "嫌疑套牌车"   # fixed value: watch-list text for a suspected cloned plate


def listed_passes(traffic: DataFrame, watch: DataFrame,
                  max_broadcast_rows: int | None = None) -> DataFrame:
    """Passes of cars on the watch list (semi join: list duplicates never
    multiply passes).  Small lists are broadcast, large ones shuffled, as the
    planner finds (``bounded_broadcast``)."""
    cars = bounded_broadcast(watch.select("car").distinct(), max_broadcast_rows)
    return traffic.join(cars, "car", "left_semi")


def to_track(df: DataFrame) -> DataFrame:
    """Pass → track record (camera dropped)."""
    return df.select(*TRACK_COLUMNS, *[c for c in ("seq",) if c in df.columns])


def with_row_key(tracks: DataFrame) -> DataFrame:
    """Add the newest-first ``row_key`` (``car_<Long.MAX - action_time>``)."""
    return tracks.withColumn("row_key", track_row_key("car", "action_time"))


def keyed_tracks(tracks: DataFrame, order: str = "seq") -> DataFrame:
    """One stored row per ``row_key``; a later write of the same key wins.
    (Two-phase ``max_by`` aggregate, hot keys are combined map-side.)  Without
    a column ``seq`` the largest record wins (:func:`with_seq`)."""
    keyed = with_row_key(with_seq(tracks) if order == "seq" else tracks)
    return latest_by_key(keyed, "row_key", order).drop(order)


def track_listed_cars(traffic: DataFrame, watch: DataFrame, **kw) -> DataFrame:
    """Keyed tracks of the listed cars."""
    return keyed_tracks(to_track(listed_passes(traffic, watch, **kw)))


def violation_king(watch: DataFrame, min_count: int = 50) -> DataFrame:
    """List entries whose text carries more than ``min_count`` unhandled violations."""
    n = F.regexp_extract("violation", "([0-9]+)次", 1).try_cast("int")
    return watch.filter(n > F.lit(min_count))


def suspected_clones(watch: DataFrame) -> DataFrame:
    return watch.filter(F.col("violation") == SUSPECTED_CLONE)


def latest_tracks(traffic: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` newest passes per car (``rank`` 1 = newest).

    ``row_number() <= n`` becomes a window group limit: each task keeps its
    ``n`` newest rows per car before the shuffle, so a hot car costs ``n``
    rows per task, not its whole history.
    """
    w = Window.partitionBy("car").orderBy(F.desc("action_time"), F.desc("seq"))
    return (to_track(with_seq(traffic)).withColumn("rank", F.row_number().over(w))
                              .filter(F.col("rank") <= n).drop("seq"))


def track_batches(tracks: DataFrame, size: int = 20, emit_partial: bool = False) -> DataFrame:
    """Write batches of ``size`` track rows in arrival order (``batch_id``)."""
    out = count_window(with_row_key(with_seq(tracks)), size, ["action_time", "seq"], emit_partial)
    return out if "seq" in tracks.columns else out.drop("seq")
