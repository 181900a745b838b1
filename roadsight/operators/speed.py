"""Speed-limit lookups: over-limit passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsight.plans.joins import bounded_broadcast

SPEEDING_COLUMNS = ["car", "monitor_id", "road_id", "real_speed", "limit_speed", "action_time"]


def _limit_side(limits: DataFrame, max_broadcast_rows: int | None) -> DataFrame:
    # Only two columns travel; how they do is the planner's choice (bounded_broadcast).
    side = limits.select("monitor_id", F.col("speed_limit").alias("limit_speed"))
    return bounded_broadcast(side, max_broadcast_rows)


def out_of_speed(traffic: DataFrame, limits: DataFrame, ratio: float = 1.1,
                 carry: list[str] | None = None,
                 max_broadcast_rows: int | None = None) -> DataFrame:
    """Passes more than ``ratio`` × limit (strict ``>``) at checkpoints that
    have a limit; passes at checkpoints without a limit row give nothing.

    ``limits`` must hold one row per checkpoint (see ``latest_by_key``).
    Works on a streaming ``traffic`` (stream-static join).
    """
    carry = carry or []
    joined = traffic.join(_limit_side(limits, max_broadcast_rows), "monitor_id", "inner")
    return (joined.filter(F.col("speed") > F.col("limit_speed") * F.lit(ratio))
                  .select("car", "monitor_id", "road_id", F.col("speed").alias("real_speed"),
                          "limit_speed", "action_time", *carry))


def with_limit(traffic: DataFrame, limits: DataFrame, default_limit: int = 80,
               carry: list[str] | None = None,
               max_broadcast_rows: int | None = None) -> DataFrame:
    """Every pass with the limit of its checkpoint, ``default_limit`` when the
    checkpoint has none.  Not filtered."""
    carry = carry or []
    joined = traffic.join(_limit_side(limits, max_broadcast_rows), "monitor_id", "left")
    return joined.select("car", "monitor_id", "road_id", F.col("speed").alias("real_speed"),
                         F.coalesce(F.col("limit_speed"), F.lit(default_limit)).alias("limit_speed"),
                         "action_time", *carry)


def speeding(passes_with_limit: DataFrame, ratio: float = 1.2) -> DataFrame:
    """Passes strictly faster than ``ratio`` × their limit."""
    return passes_with_limit.filter(F.col("real_speed") > F.col("limit_speed") * F.lit(ratio))
