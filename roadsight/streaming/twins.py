"""Streaming versions of the operators, sharing the batch column logic.

Event-time rules of the source jobs: traffic watermark 5 s (bounded
disorder), violation / police-action watermarks 2 s on each input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadsight.functions.exprs import bitmap_offset, micros, event_time, half_up_mean, window_bounds_ms
from roadsight.operators import danger as danger_ops
from roadsight.operators.dispatch import P_COLS, _alert, tagged_union
from roadsight.plans.sequence import with_seq
from roadsight.streaming.stateful import (
    CLONE_OUTPUT, FULL_INPUT, FULL_OUTPUT, PAIR_OUTPUT, BucketTraces, ChainTraces, ClonedPlateProcessor, CloneRule,
    DangerousCarProcessor, IntervalOuterProcessor, PairingProcessor, PairRule, RunningCountProcessor, TOP_OUTPUT,
    TopRows, danger_output, part_schema, running_output,
)

TRAFFIC_DELAY = "5 seconds"
DISPATCH_DELAY = "2 seconds"
ASCENDING = "0 seconds"


def watermarked(traffic: DataFrame, ts: str = "action_time", delay: str = TRAFFIC_DELAY) -> DataFrame:
    """``event_time`` with a watermark of ``delay``; ``"0 seconds"`` is right for rows in ascending order."""
    return traffic.withColumn("event_time", event_time(ts)).withWatermark("event_time", delay)


def avg_speed_stream(traffic: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                     keep_window: bool = False) -> DataFrame:
    """Sliding average per checkpoint; append mode emits each window once
    the watermark passes its end."""
    g = (watermarked(traffic).groupBy(F.window("event_time", window, slide), "monitor_id")
         .agg(F.sum(micros("speed")).alias("_c"), F.count("speed").alias("_s"), F.count(F.lit(1)).alias("_n")))
    out = [*window_bounds_ms(), "monitor_id",
           half_up_mean(F.col("_c"), F.col("_s")).alias("avg_speed"),
           F.col("_n").cast("int").alias("car_count")]
    return g.select(*(["window"] if keep_window else []), *out)


#: Lanes that a window's checkpoints are dealt to before the last choice.
TOP_LANES = 16


def top_n_stream(traffic: DataFrame, n: int = 3, lanes: int = TOP_LANES) -> DataFrame:
    """Per-window top ``n`` of the averages in two steps: the ``n`` best of each lane of a
    window's checkpoints, then the ``n`` best of those.  Each step reads its rows once and holds
    ``n`` of them; no list of a window's averages is kept."""
    avg = avg_speed_stream(traffic)
    lane = F.pmod(F.xxhash64("monitor_id"), F.lit(lanes))
    some = avg.withColumn("_lane", lane).groupBy("start_time", "end_time", "_lane").transformWithState(
        TopRows(n), TOP_OUTPUT, "Append", "EventTime", eventTimeColumnName="event_time")
    top = some.groupBy("start_time", "end_time").transformWithState(
        TopRows(n), TOP_OUTPUT, "Append", "EventTime")
    return top.drop("event_time")


def area_vehicles_stream(traffic: DataFrame, window: str = "30 seconds") -> DataFrame:
    """Distinct cars per area and window: streaming dedup on (window, area,
    car) — state evicted by watermark — then a count per (window, area)."""
    t = watermarked(traffic).withColumn("window", F.window("event_time", window))
    dedup = t.dropDuplicates(["window", "area_id", "car"])
    g = dedup.groupBy("window", "area_id").agg(F.count(F.lit(1)).cast("int").alias("car_count"))
    out = g.select(*window_bounds_ms(), "area_id", "car_count")
    from roadsight.operators.flow import _area_text
    return out.withColumn("alert_text", _area_text("car_count"))


def violation_action_interval_stream(violations: DataFrame, actions: DataFrame,
                                     lower_ms: int = 0, upper_ms: int = 10_000) -> DataFrame:
    """Stream-stream interval join; join state is evicted from the time range
    and both watermarks.  As in batch, rows are also keyed by time bucket so a
    hot car spreads over tasks."""
    width = max(upper_ms - lower_ms, 1)
    v = (violations.select("car", "violation", "create_time")
         .withColumn("v_time", event_time("create_time")).withWatermark("v_time", DISPATCH_DELAY)
         .withColumn("v_b", F.explode(F.sequence(
             F.floor((F.col("create_time") + lower_ms) / width).cast("long"),
             F.floor((F.col("create_time") + upper_ms) / width).cast("long")))))
    p = (actions.select(F.col("car").alias("p_car"), *P_COLS)
         .withColumn("p_time", event_time("action_time")).withWatermark("p_time", DISPATCH_DELAY)
         .withColumn("p_b", F.floor(F.col("action_time") / width).cast("long")))
    cond = ((F.col("car") == F.col("p_car")) & (F.col("v_b") == F.col("p_b"))
            & (F.col("p_time") >= F.col("v_time") + F.expr(f"INTERVAL {lower_ms} MILLISECONDS"))
            & (F.col("p_time") <= F.col("v_time") + F.expr(f"INTERVAL {upper_ms} MILLISECONDS")))
    j = v.join(p, cond, "inner")
    return _alert(j.select("car", "violation", "create_time", *P_COLS))


#: Width of the buckets that a car's machine is run in; results wait for the end of their bucket.
KEY_BUCKET_MS = 60_000


#: Groups that cars are dealt to in the chain of their buckets.
CAR_GROUPS = 1024


def _in_buckets(records: DataFrame, rule, width_ms: int) -> DataFrame:
    """A keyed machine in three steps: an aggregation gathers the records of a (car, bucket), both traces of
    them are run where they lie, and each car chains its buckets.

    State and work of a hot car lie in its buckets; the chain keeps one record a car.  Records never go
    to Python's state one by one: they rest in the aggregation until the watermark closes their bucket, and
    only a record whose bucket is closed is too late.
    """
    from functools import partial

    from pyspark.sql.pandas.types import to_arrow_schema
    tie, fields = records.schema["seq"].dataType, rule.record.fieldNames()
    whole = records.groupBy(F.window("event_time", f"{width_ms} milliseconds").alias("bucket"), "car").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("records"))
    whole = whole.select(
        F.pmod(F.xxhash64("car"), F.lit(CAR_GROUPS)).cast("long").alias("cars"), "car",
        F.call_function("div", F.unix_millis(F.col("bucket.start")), F.lit(width_ms)).alias("bucket"), "records")
    schema = part_schema(rule, tie)
    run = partial(BucketTraces(rule, width_ms, tie).of_batches, schema=to_arrow_schema(schema))
    parts = whole.mapInArrow(run, schema)
    return parts.groupBy("cars", "lane").transformWithState(ChainTraces(rule, width_ms, tie), rule.result, "Append", "EventTime")


def cloned_plate_stream(traffic: DataFrame, gap_ms: int = 10_000, distinct_monitors: bool = False,
                        key_bucket_ms: int | None = KEY_BUCKET_MS, delay: str = ASCENDING) -> DataFrame:
    """Cloned plates.  The source job takes times as ascending; pass a ``delay`` for rows out of order.

    ``key_bucket_ms=None`` keys the state by car alone and reports as soon as the
    watermark has passed a record, which suits streams without hot cars."""
    src = watermarked(with_seq(traffic), delay=delay).select("car", "action_time", "seq", "monitor_id", "event_time")
    if key_bucket_ms is not None:
        return _in_buckets(src, CloneRule(gap_ms, distinct_monitors), key_bucket_ms)
    processor = ClonedPlateProcessor(gap_ms, distinct_monitors).order_by(src.schema["seq"].dataType)
    return src.groupBy("car").transformWithState(processor, CLONE_OUTPUT, "Append", "EventTime")


def _dispatch_union(violations: DataFrame, actions: DataFrame) -> DataFrame:
    """Both inputs as one record stream, each under its own watermark (the slower one counts)."""
    if "seq" not in violations.columns or "seq" not in actions.columns:
        violations, actions = with_seq(violations.drop("seq")), with_seq(actions.drop("seq"))
    marked = [df.withColumn("event_time", event_time(ts)).withWatermark("event_time", DISPATCH_DELAY)
              for df, ts in ((violations, "create_time"), (actions, "action_time"))]
    return tagged_union(*marked, more=["event_time"])


def pair_violation_action_stream(violations: DataFrame, actions: DataFrame, timeout_ms: int = 5_000,
                                 key_bucket_ms: int | None = KEY_BUCKET_MS) -> DataFrame:
    """One-to-one pairing; ``key_bucket_ms`` as for :func:`cloned_plate_stream`."""
    u = _dispatch_union(violations, actions)
    if key_bucket_ms is not None:
        return _in_buckets(u, PairRule(timeout_ms), key_bucket_ms)
    processor = PairingProcessor(timeout_ms).order_by(u.schema["seq"].dataType)
    return u.groupBy("car").transformWithState(processor, PAIR_OUTPUT, "Append", "EventTime")


def classify_violation_action_stream(violations: DataFrame, actions: DataFrame, lower_ms: int = 0,
                                     upper_ms: int = 10_000, key_bucket_ms: int = 10 * 60_000) -> DataFrame:
    """Full outer interval join in a stream: ``matched`` / ``violation_only`` / ``action_only``.

    Keyed by (car, time bucket): a record is owned by its bucket and copied into the next and the
    one before where those hold times it can match, so a hot car spreads over its buckets and no
    copy reports a false lone record (:class:`IntervalOuterProcessor`).
    """
    reach = max(abs(lower_ms), abs(upper_ms))
    width = max(key_bucket_ms, reach)
    u = _dispatch_union(violations, actions)
    span = F.sequence(F.floor((F.col("t") - F.lit(reach)) / F.lit(width)), F.floor((F.col("t") + F.lit(reach)) / F.lit(width)))
    u = (u.withColumn("_b", F.explode(span))
          .withColumn("_own", F.col("_b") == F.floor(F.col("t") / F.lit(width)))
          .withColumn("_hit", F.lit(False)))
    cols = ["car", "_b", *FULL_INPUT.fieldNames(), "event_time"]
    u = u.withColumn("seq", F.lit(0).cast("long")).select(*cols)   # order within a time plays no part here
    return u.groupBy("car", "_b").transformWithState(
        IntervalOuterProcessor(lower_ms, upper_ms), FULL_OUTPUT, "Append", "EventTime")


def dangerous_car_stream(passes_with_limit: DataFrame, times: int = 3, within_ms: int = 120_000,
                         ratio: float = 1.2, key_bucket_ms: int = 30 * 60 * 1000,
                         emit: str = "longest", condition: Column | None = None) -> DataFrame:
    """Longest match ending at each speeding pass, or with ``emit="all"`` every match.

    State is keyed by (car, ``key_bucket_ms`` time bucket), so a hot car is
    spread over its buckets; larger buckets mean fewer keys, smaller ones
    less state per key."""
    if emit not in ("all", "longest"):
        raise ValueError("emit must be 'all' or 'longest'")
    # The watermark tracks all passes (as the source job assigns it before the
    # pattern).  Catalyst would move the pattern's condition below the watermark
    # unless it depends on the event time, so it hangs on a zero made of that.
    marked = watermarked(with_seq(passes_with_limit))
    nothing = F.pmod(F.unix_millis("event_time"), F.lit(1))
    fast = danger_ops.speeding_by(ratio) if condition is None else condition
    sp = marked.where(F.when(nothing == 0, fast)).select(
        "car", "action_time", "seq", "monitor_id", "real_speed", "limit_speed",
        micros("real_speed").alias("micros"), "event_time")
    # Key = (car, bucket of key_bucket_ms >= within_ms): a pass is owned by its
    # bucket; passes in the last within_ms of a bucket are also copied into
    # the next bucket as halo, so every match is complete in its owner's key.
    width = max(key_bucket_ms, within_ms)
    bucket = F.floor(F.col("action_time") / F.lit(width)).cast("long")
    in_tail = F.pmod(F.col("action_time"), F.lit(width)) >= F.lit(width - within_ms)
    copies = F.when(in_tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sp = (sp.withColumn("_copy", F.explode(copies))
            .withColumn("_b", bucket + F.col("_copy"))
            .withColumn("_own", F.col("_copy") == 0).drop("_copy"))
    tie = sp.schema["seq"].dataType
    processor = DangerousCarProcessor(times, within_ms).order_by(tie)
    m = sp.groupBy("car", "_b").transformWithState(processor, danger_output(tie), "Append", "EventTime")
    if emit == "all":  # a match may start at any pass of the longest one that leaves ``times``
        k = F.explode(F.sequence(F.lit(0), F.size("events") - F.lit(times)))
        m = m.withColumn("_k", k).withColumn("events", F.slice("events", F.col("_k") + 1, F.size("events") - F.col("_k")))
    return m.select("car", *danger_ops._summarise(F.col("events")))


def late_rows(df: DataFrame, ts: str = "action_time", arrival: str = "seq",
              delay_ms: int = 5_000, bucket: int = 1_000_000) -> DataFrame:
    """Batch audit of lateness: rows whose event time is more than
    ``delay_ms`` behind the largest event time that arrived before them (in
    ``arrival`` order) — the rows a watermark of that delay may drop.  A
    per-row bound: micro-batches advance the watermark less often, so a
    stream drops a subset of these.  ``max_seen_time`` is that largest time.

    The running maximum over the whole arrival order is a bucketed ordered
    scan (``bucket`` arrival ids per bucket), not a single-task window.
    """
    from roadsight.plans.sequence import ordered_scan
    s = ordered_scan(df, [], arrival, arrival, maxes=[ts], bucket_ms=bucket)
    return (s.filter(F.col(f"_max_{ts}") - F.lit(delay_ms) > F.col(ts))
             .select(*df.columns, F.col(f"_max_{ts}").alias("max_seen_time")))


def area_vehicles_running_stream(traffic: DataFrame, window: str = "30 seconds") -> DataFrame:
    """Running distinct-vehicle count per area and window in update mode:
    every micro-batch emits the current count of each window it touched
    (the per-element trigger of the source job, at micro-batch grain).
    Dedup state and counts are evicted by the watermark."""
    t = watermarked(traffic).withColumn("window", F.window("event_time", window))
    dedup = t.dropDuplicates(["window", "area_id", "car"])
    g = dedup.groupBy("window", "area_id").agg(F.count(F.lit(1)).cast("int").alias("car_count"))
    return g.select(*window_bounds_ms(), "area_id", "car_count")


def area_vehicles_running_records_stream(traffic: DataFrame, window_ms: int = 30_000) -> DataFrame:
    """A running distinct-vehicle count for every pass, in event order (the per-element trigger).

    Same rows as ``flow.area_vehicles_running``; keyed by (area, window), of which the state keeps the
    cars and the passes that the watermark has not passed.
    """
    t = watermarked(with_seq(traffic))
    src = t.withColumn("start_time", F.col("action_time") - F.pmod("action_time", F.lit(window_ms))).select(
        "area_id", "start_time", "action_time", "seq", "car", "event_time")
    tie = src.schema["seq"].dataType
    processor = RunningCountProcessor(window_ms).order_by(tie)
    return src.groupBy("area_id", "start_time").transformWithState(processor, running_output(tie), "Append", "EventTime")


def area_vehicles_bitmap_stream(traffic: DataFrame, window: str = "30 seconds", num_bits: int = 1 << 25) -> DataFrame:
    """Distinct vehicles per area and window from bitmaps whose state follows the bits that are set.

    State is a set of positions a chunk of 32,768 bits; finished chunks become containers
    (:func:`roadsight.operators.flow.containers`) and are gathered a window.
    """
    t = watermarked(traffic).withColumn("_o", bitmap_offset("car", num_bits))
    chunks = t.groupBy(F.window("event_time", window), "area_id", F.bitmap_bucket_number("_o").alias("bucket")).agg(
        F.collect_set(F.bitmap_bit_position("_o").cast("int")).alias("_set"))
    out = chunks.groupBy("window", "area_id").agg(
        F.sum(F.size("_set")).cast("int").alias("car_count"),
        F.collect_list(F.struct("bucket", F.sort_array("_set").alias("offsets"), F.lit(None).cast("binary").alias("bits"))).alias("bitmap"))
    from roadsight.operators.flow import _area_text
    return out.select(*window_bounds_ms(), "area_id", "car_count", "bitmap").withColumn("alert_text", _area_text("car_count"))


def area_vehicles_ingest_stream(stamped: DataFrame, window: str = "30 seconds") -> DataFrame:
    """Distinct vehicles per area and window of ingestion, over rows that ``stamp_arrivals`` stored."""
    marked = watermarked(stamped, "arrival_time", "0 seconds")
    dedup = marked.withColumn("window", F.window("event_time", window)).dropDuplicates(["window", "area_id", "car"])
    g = dedup.groupBy("window", "area_id").agg(F.count(F.lit(1)).cast("int").alias("car_count"))
    return g.select(*window_bounds_ms(), "area_id", "car_count")
