"""Violation ↔ police-action matching.

Two forms, as in the two source jobs:

* interval join — every police action of the same car within
  ``[violation time + lower, violation time + upper]`` (both ends inclusive);
  the full form also reports violations without any action and actions
  without any violation;
* pairing — a per-car state machine pairing one violation with one action
  (either may come first) when they are at most ``timeout_ms`` apart; a
  record left unpaired is reported as unmatched (``expired``), a pending
  record replaced by a newer one of the same kind as ``superseded``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsight.plans.joins import range_join
from roadsight.plans.sequence import DEFAULT_BUCKET_MS, ordered_scan, with_seq

V_COLS = ["car", "violation", "create_time"]
P_COLS = ["police_id", "action_status", "action_time"]
OUT_COLS = ["outcome", "car", "violation", "create_time", "police_id", "action_status",
            "action_time"]


def _alert(df: DataFrame) -> DataFrame:
    text = F.concat(F.lit("违法车辆【"), F.col("car"), F.lit("】，已经有交警出警了，警号为【"),
                    F.col("police_id"), F.lit("】，出警状态为【"), F.col("action_status"),
                    F.lit("】，出警时间为【"), F.col("action_time").cast("string"), F.lit("】"))
    return df.withColumn("alert_text", text)


# fixed values: labels of the unmatched outcomes
NO_VIOLATION = "没有对应的违法车辆信息"
NO_ACTION = "该违法车辆在5分钟内没有交警出警"


def pairing_alert(pairs: DataFrame) -> DataFrame:
    """Pairing result with its alert line: the pair's facts, or the label of the unmatched side."""
    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("null"))

    matched = F.concat(F.lit("违法车辆【"), text("car"), F.lit("】，违法时间【"), text("create_time"),
                       F.lit("】,已经有交警出警了，警号为【"), text("police_id"), F.lit("】,出警的状态为【"),
                       text("action_status"), F.lit("】,出警的时间为【"), text("action_time"), F.lit("】"))
    return pairs.withColumn("alert_text", F.when(F.col("outcome") == "matched", matched)
                            .when(F.col("outcome") == "unmatched_action", NO_VIOLATION).otherwise(NO_ACTION))


def _sides(violations: DataFrame, actions: DataFrame):
    v = with_seq(violations).select(*V_COLS, F.col("seq").alias("v_seq"))
    p = with_seq(actions).select("car", *P_COLS, F.col("seq").alias("p_seq"))
    return v, p


def violation_action_interval(violations: DataFrame, actions: DataFrame, lower_ms: int = 0,
                              upper_ms: int = 10_000) -> DataFrame:
    """All (violation, action) pairs of a car with the action time in
    ``[create_time + lower_ms, create_time + upper_ms]``, with alert text.

    Bucketed range join (see :func:`roadsight.plans.joins.range_join`): a join
    task sees one car's rows of two bucket widths, never a whole car.
    """
    j = range_join(violations.select(*V_COLS), actions.select("car", *P_COLS), "car", "create_time", "action_time", lower_ms, upper_ms)
    return _alert(j.select("car", "violation", "create_time", *P_COLS))


def classify_violation_action(violations: DataFrame, actions: DataFrame, lower_ms: int = 0,
                              upper_ms: int = 10_000) -> DataFrame:
    """Full-outer form of the interval join in one result, ``outcome`` in
    ``matched`` / ``violation_only`` / ``action_only``.

    The lone sides are anti joins on car and ``seq`` of the matched pairs (the
    record itself where a source gives no ``seq``: duplicates share their
    outcome), which shuffle evenly whatever the car distribution.
    """
    v, p = _sides(violations, actions)
    pairs = range_join(v, p, "car", "create_time", "action_time", lower_ms, upper_ms)
    matched = pairs.select(F.lit("matched").alias("outcome"), "car", "violation", "create_time",
                           *P_COLS)
    v_only = (v.join(pairs.select("car", "v_seq").distinct(), ["car", "v_seq"], "left_anti")
               .select(F.lit("violation_only").alias("outcome"), *V_COLS,
                       *[F.lit(None).cast(t).alias(c) for c, t in
                         zip(P_COLS, ["string", "string", "long"])]))
    p_only = (p.join(pairs.select("car", "p_seq").distinct(), ["car", "p_seq"], "left_anti")
               .select(F.lit("action_only").alias("outcome"), "car",
                       F.lit(None).cast("string").alias("violation"),
                       F.lit(None).cast("long").alias("create_time"), *P_COLS))
    return matched.unionByName(v_only).unionByName(p_only)


def pair_rule(timeout_ms: int):
    """Island rule (SQL): a record starts a new pairing island when it is more
    than ``timeout_ms`` after its predecessor or of the same kind (the
    pending one is replaced)."""
    def rule(prev, cur):
        return (f"({cur('t')} - {prev('t')}) > {int(timeout_ms)} "
                f"OR {cur('kind')} = {prev('kind')}")
    return rule


def tagged_union(violations: DataFrame, actions: DataFrame, more: tuple | list = ()) -> DataFrame:
    """Both inputs as one record stream: ``car, t, seq, kind ('v'|'p')`` + payload (+ columns ``more``).

    Where either input has no ``seq``, both are ordered by their records (:func:`with_seq`).
    """
    if "seq" not in violations.columns or "seq" not in actions.columns:
        violations, actions = with_seq(violations.drop("seq")), with_seq(actions.drop("seq"))
    v = violations.select("car", F.col("create_time").alias("t"), "seq", F.lit("v").alias("kind"),
                          "violation", F.lit(None).cast("string").alias("police_id"),
                          F.lit(None).cast("string").alias("action_status"), *more)
    p = actions.select("car", F.col("action_time").alias("t"), "seq", F.lit("p").alias("kind"),
                       F.lit(None).cast("string").alias("violation"), "police_id",
                       "action_status", *more)
    return v.unionByName(p)


def pair_violation_action(violations: DataFrame, actions: DataFrame, timeout_ms: int = 5_000,
                          bucket_ms: int = DEFAULT_BUCKET_MS, split: str = "time") -> DataFrame:
    """One-to-one pairing with timeout (see module doc), in event-time order.

    Closed form over the per-car record stream: islands split where the gap
    exceeds ``timeout_ms`` or two records of the same kind follow each other;
    the 2nd, 4th, ... record of an island pairs with its predecessor, the
    last record of an odd-sized island stays unmatched.  Output columns:
    ``outcome`` (``matched`` / ``unmatched_violation`` / ``unmatched_action``),
    ``reason`` (``expired`` / ``superseded`` for unmatched rows, ``incomplete``
    for records without car or time, which nothing can match) and the violation
    and action fields.
    """
    u = tagged_union(violations, actions)
    s = ordered_scan(u, ["car"], "t", "seq", carry=["kind", "violation", "police_id",
                                                    "action_status"],
                     new_island=pair_rule(timeout_ms), bucket_ms=bucket_ms, split=split)
    # odd: the 2nd, 4th, ... record of an island, matched with its predecessor;
    # lone: the last record of an odd-sized island.  One projection, no union.
    odd = "(_pos - _start) % 2 = 1"
    is_v = "kind = 'v'"

    def side(name: str, v_side: bool) -> str:
        mine = is_v if v_side else f"NOT ({is_v})"
        return f"CASE WHEN {mine} THEN {name} WHEN {odd} THEN prev_{name} END AS {name}"

    superseded = f"next_kind = kind AND next_t - t <= {int(timeout_ms)}"
    lone = u.where("car IS NULL OR t IS NULL").selectExpr(
        f"CASE WHEN {is_v} THEN 'unmatched_violation' ELSE 'unmatched_action' END AS outcome",
        "'incomplete' AS reason", "car", "violation", f"CASE WHEN {is_v} THEN t END AS create_time",
        "police_id", "action_status", f"CASE WHEN NOT ({is_v}) THEN t END AS action_time")
    paired = s.where(f"({odd}) OR _next_is_start").selectExpr(
        f"CASE WHEN {odd} THEN 'matched' WHEN {is_v} THEN 'unmatched_violation' "
        "ELSE 'unmatched_action' END AS outcome",
        f"CASE WHEN {odd} THEN CAST(NULL AS STRING) WHEN {superseded} THEN 'superseded' "
        "ELSE 'expired' END AS reason",
        "car", side("violation", True),
        f"CASE WHEN {is_v} THEN t WHEN {odd} THEN prev_t END AS create_time",
        side("police_id", False), side("action_status", False),
        f"CASE WHEN NOT ({is_v}) THEN t WHEN {odd} THEN prev_t END AS action_time")
    return paired.unionByName(lone)
