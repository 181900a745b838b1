"""Cloned-plate detection (X1) and its violation-list projection (K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsight.plans.sequence import DEFAULT_BUCKET_MS, ordered_scan, with_seq

CLONE_MESSAGE = "涉嫌套牌车"   # fixed value: warning text of a cloned-plate alert


def clone_rule(gap_ms: int = 10_000, distinct_monitors: bool = False):
    """Island rule (SQL): a pass opens a new candidate pair when it is
    ``gap_ms`` or more after the previous pass (and, optionally, at the same
    checkpoint)."""
    def rule(prev, cur):
        brk = f"({cur('action_time')} - {prev('action_time')}) >= {int(gap_ms)}"
        if distinct_monitors:
            brk = f"({brk}) OR ({cur('monitor_id')} = {prev('monitor_id')})"
        return brk
    return rule


def cloned_plate(traffic: DataFrame, gap_ms: int = 10_000, distinct_monitors: bool = False,
                 bucket_ms: int = DEFAULT_BUCKET_MS, split: str = "time") -> DataFrame:
    """Two consecutive passes of one car less than ``gap_ms`` apart.

    Keyed state semantics, in event-time order: the first pass is held; a
    next pass within ``gap_ms`` raises a warning and clears the state (pairs
    never overlap), otherwise the later pass replaces the held one.  Closed
    form: islands split where the gap is ``>= gap_ms``; every 2nd, 4th, ...
    pass of an island pairs with its predecessor.  Ties in time are ordered
    by ``seq``, or by the record itself where there is none (:func:`with_seq`).  ``split``/``bucket_ms``: see :func:`ordered_scan`.
    """
    s = ordered_scan(with_seq(traffic), ["car"], "action_time", "seq", carry=["monitor_id"],
                     new_island=clone_rule(gap_ms, distinct_monitors), bucket_ms=bucket_ms,
                     split=split)
    return s.where("(_pos - _start) % 2 = 1").selectExpr(
        "car", "prev_monitor_id AS first_monitor", "monitor_id AS second_monitor",
        "prev_action_time AS first_time", "action_time AS warning_time",
        f"'{CLONE_MESSAGE}' AS warning_msg")


def clone_to_violation(warnings: DataFrame) -> DataFrame:
    """Warnings as watch-list rows (``car, violation, create_time``)."""
    return warnings.select("car", F.col("warning_msg").alias("violation"),
                           F.col("warning_time").alias("create_time"))
