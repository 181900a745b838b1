"""Dangerous driving: repeated heavy speeding within a short time.

Pattern (per car, event time): ``times`` or more passes faster than
``ratio`` × limit, first to last strictly less than ``within_ms`` apart;
slower passes in between are skipped.  ``emit="all"`` gives every match
(every run of consecutive speeding passes of length >= ``times`` that fits
the time bound), ``emit="longest"`` the longest match ending at each pass.

Scaling: a speeding pass is owned by the time bucket of its car (30 minutes
wide) and copied into the next one where it lies in the bucket's tail, so a
match (which spans less than ``within_ms``) is always complete inside the
owner's partition ``(car, bucket)``.  No task holds more than a bucket and a
tail of one car, however many passes that car has in total.

A match is a run of consecutive positions.  Its first position comes from
counting: every pass is also an expiry ``within_ms`` later, and running sums
over both in time order say how many passes, and how much speed, lie behind.
No row ever holds the list of its passes; lists are joined to the matches
only for the alert text (``text=False`` leaves it out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadsight.functions.exprs import micros, half_up_mean
from roadsight.plans.sequence import with_seq


def _element_text(x: Column, i: Column) -> Column:
    return F.concat(F.lit("第"), (i + 1).cast("string"), F.lit("个卡口"), x["monitor_id"],
                    F.lit("，车速为："), x["real_speed"].cast("string"),
                    F.lit("，该卡口的限速为："), x["limit_speed"].cast("string"))


def _text(events: Column, n: Column, avg: Column) -> Column:
    return F.concat(F.lit("当前车辆"), F.col("car"), F.lit("，涉嫌危险驾驶，它在两分钟内经过的卡口数为："),
                    n.cast("string"), F.array_join(F.transform(events, _element_text), ""),
                    F.lit("它在两分钟内的平均车速为："), avg.cast("string"))


def _summarise(events: Column) -> list[Column]:
    n = F.size(events)
    total = F.aggregate(events, F.lit(0).cast("long"), lambda acc, x: acc + x["micros"])
    avg = half_up_mean(total, n)
    return [F.element_at(events, 1)["action_time"].alias("start_time"),
            F.element_at(events, -1)["action_time"].alias("end_time"),
            n.alias("pass_count"), avg.alias("avg_speed"), _text(events, n, avg).alias("violation")]


BUCKET_MS = 30 * 60_000


def speeding_by(ratio: float) -> Column:
    """The pattern's condition: faster than ``ratio`` × limit."""
    return F.col("real_speed") > F.col("limit_speed") * F.lit(ratio)


def _runs(sp: DataFrame, within_ms: int) -> DataFrame:
    """Every pass of a (car, bucket) with its position ``_idx`` and, for the longest run that ends at it:
    first position ``_lo``, start time ``_from`` and speed before it ``_before`` (``_sum``: up to the pass)."""
    width = max(BUCKET_MS, within_ms)
    bucket = F.floor(F.col("action_time") / F.lit(width)).cast("long")
    in_tail = F.pmod(F.col("action_time"), F.lit(width)) >= F.lit(width - within_ms)
    copies = (sp.withColumn("_copy", F.explode(F.when(in_tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
                .withColumn("_b", bucket + F.col("_copy")).withColumn("_own", F.col("_copy") == 0).drop("_copy"))
    # kind 0: the pass expires, before anything at that time; kind 1: the pass itself
    both = copies.withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "_at", F.col("action_time") + F.when(F.col("_kind") == 0, F.lit(within_ms)).otherwise(F.lit(0)))
    order = ["_at", "_kind", "action_time", "seq"]
    upto = Window.partitionBy("car", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("car", "_b").orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed, expired = F.col("_kind"), F.lit(1) - F.col("_kind")
    counted = both.select(
        "*", F.sum(passed).over(upto).alias("_idx"), (F.sum(expired).over(upto) + 1).alias("_lo"),
        F.sum(F.col("micros") * passed).over(upto).alias("_sum"), F.sum(F.col("micros") * expired).over(upto).alias("_before"),
        # the next expiry is that of the run's first pass
        F.last(F.when(F.col("_kind") == 0, F.col("action_time")), ignorenulls=True).over(back).alias("_from"))
    return counted.where("_kind = 1").drop("_kind", "_at")


def dangerous_car(passes_with_limit: DataFrame, times: int = 3, within_ms: int = 120_000,
                  ratio: float = 1.2, emit: str = "longest", condition: Column | None = None,
                  text: bool = True) -> DataFrame:
    """Matches of the dangerous-driving pattern (see module doc).

    ``passes_with_limit`` needs ``car, monitor_id, real_speed, limit_speed,
    action_time``; ``seq`` is optional (:func:`with_seq`).  Passes without car
    or time belong to no match.  ``condition`` replaces the pattern's condition on a
    pass.  Output: ``car, start_time, end_time, pass_count, avg_speed`` (HALF_UP,
    2 decimals) and the alert text ``violation``.
    """
    if emit not in ("all", "longest"):
        raise ValueError("emit must be 'all' or 'longest'")
    fast = speeding_by(ratio) if condition is None else condition
    sp = with_seq(passes_with_limit).where(fast).where("car IS NOT NULL AND action_time IS NOT NULL").select(
        "car", "action_time", "seq", "monitor_id", "real_speed", "limit_speed",
        micros("real_speed").alias("micros"))
    runs = _runs(sp, within_ms)
    ends = runs.where(F.col("_own") & (F.col("_idx") - F.col("_lo") + 1 >= times)).select(
        "car", "_b", "_idx", "_lo", "_sum", "_before", "_from", F.col("action_time").alias("end_time"))
    if emit == "all":  # every first position that leaves ``times`` passes
        starts = runs.select("car", "_b", F.col("_idx").alias("_s"), F.col("action_time").alias("start_time"),
                             (F.col("_sum") - F.col("micros")).alias("_off"))
        m = ends.withColumn("_s", F.explode(F.sequence("_lo", F.col("_idx") - F.lit(times - 1)))).join(
            starts, ["car", "_b", "_s"])
    else:
        m = ends.withColumnsRenamed({"_lo": "_s", "_from": "start_time", "_before": "_off"})
    n = (F.col("_idx") - F.col("_s") + 1).cast("int")
    m = m.select("car", "_b", "_s", "_idx", "start_time", "end_time", n.alias("pass_count"),
                 half_up_mean(F.col("_sum") - F.col("_off"), n).alias("avg_speed"))
    out = ["car", "start_time", "end_time", "pass_count", "avg_speed"]
    if not text:
        return m.select(*out)
    event = runs.select("car", "_b", F.col("_idx").alias("_i"), F.struct("monitor_id", "real_speed", "limit_speed").alias("_e"))
    listed = (m.withColumn("_i", F.explode(F.sequence("_s", "_idx"))).join(event, ["car", "_b", "_i"])
              .groupBy("_b", "_s", "_idx", *out).agg(F.sort_array(F.collect_list(F.struct("_i", "_e"))).alias("_list")))
    return listed.select(*out, _text(F.transform("_list", lambda x: x["_e"]), F.col("pass_count"), F.col("avg_speed")).alias("violation"))


def daily_violation_upsert(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Collapse violation reports to one row per car and day (UTC): the first
    report of the day keeps its text and time, ``out_count`` is the largest.

    ``max``/``min_by`` are two-phase aggregates, so many reports of one car
    are combined map-side.  Result: ``car, day, violation, create_time,
    out_count``; write it back with dynamic partition overwrite on ``day``.
    """
    cols = ["car", "violation", "create_time", "out_count"]
    allr = existing.select(*cols).unionByName(new.select(*cols))
    day = F.date_from_unix_date(F.call_function("div", F.col("create_time"), F.lit(86_400_000)).cast("int"))
    first = F.min_by(F.struct("violation", "create_time"), F.struct("create_time", "violation"))
    g = allr.withColumn("day", day).groupBy("car", "day").agg(
        first.alias("_first"), F.max("out_count").alias("out_count"))
    return g.select("car", "day", F.col("_first.violation").alias("violation"),
                    F.col("_first.create_time").alias("create_time"), "out_count")
