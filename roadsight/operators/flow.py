"""Windowed checkpoint and area statistics.

All windows are event-time, epoch-aligned and ``[start, end)``.  The same
functions run on streaming frames (add ``withWatermark`` on ``event_time``
first); grouping by ``F.window`` lets Spark evict window state by watermark.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadsight.plans.joins import bounded_broadcast
from roadsight.functions.exprs import (
    bitmap_offset, duration_ms, event_time, half_up_mean, window_bounds_ms,
)
from roadsight.plans.sequence import ordered_scan, with_unique_seq
from roadsight.sources.dims import area_names


def _with_event_time(traffic: DataFrame) -> DataFrame:
    if "event_time" in traffic.columns:
        return traffic
    return traffic.withColumn("event_time", event_time("action_time"))


def _pane_windows(traffic: DataFrame, window: str, slide: str, aggs: dict) -> DataFrame:
    """Sliding-window aggregation through panes ("no pane, no gain").

    Rows are first aggregated per (checkpoint, pane) where the pane is
    ``gcd(window, slide)`` — one pass over the raw rows, combined map-side —
    and only the small pane table is assigned to the ``window / pane``
    overlapping windows and re-aggregated.  ``F.window`` with a slide would
    instead copy every raw row into every overlapping window before the
    aggregation.  ``aggs`` maps output name → (SQL expression per row,
    "sum" or "count").  Windows are epoch-aligned ``[start, start + window)``.
    """
    w, sl = duration_ms(window), duration_ms(slide)
    pane = gcd(w, sl)
    per_row = [F.expr(f"{kind}({e})").alias(n)
               for n, (e, kind) in aggs.items()]
    panes = (traffic.withColumn("_pane", F.col("action_time") - F.pmod("action_time", F.lit(pane)))
                    .groupBy("monitor_id", "_pane").agg(*per_row))
    lo = F.col("_pane") - F.lit(w - pane)
    first = lo + F.pmod(-lo, F.lit(sl))
    last = F.col("_pane") - F.pmod("_pane", F.lit(sl))
    spread = panes.withColumn("start_time", F.explode(F.sequence(first, last, F.lit(sl))))
    return (spread.groupBy("start_time", "monitor_id")
                  .agg(*[F.sum(n).alias(n) for n in aggs])
                  .withColumn("end_time", F.col("start_time") + F.lit(w)))


def avg_speed(traffic: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
              two_decimal_input: bool = True) -> DataFrame:
    """Average speed and number of passes per checkpoint per sliding window.

    Pane-based (see :func:`_pane_windows`): raw rows are aggregated once,
    two-phase, per (checkpoint, pane).  The mean is rounded HALF_UP to two
    decimals; for speeds with at most six decimals (``two_decimal_input``, the
    default) it is computed exactly from integer millionths.  Passes without
    speed count as passes but not in the mean.
    """
    if two_decimal_input:
        g = _pane_windows(traffic, window, slide, {"_c": ("CAST(ROUND(speed * 1000000) AS BIGINT)", "sum"),
                                                   "_s": ("speed", "count"), "_n": ("1", "count")})
        avg = half_up_mean(F.col("_c"), F.col("_s"))
    else:
        g = _pane_windows(traffic, window, slide, {"_s": ("speed", "sum"), "_m": ("speed", "count"),
                                                   "_n": ("1", "count")})
        avg = F.round(F.col("_s") / F.nullif(F.col("_m"), F.lit(0)), 2)
    return g.select("start_time", "end_time", "monitor_id", avg.alias("avg_speed"),
                    F.col("_n").cast("int").alias("car_count"))


def flow(traffic: DataFrame, window: str = "5 minutes", slide: str | None = "1 minute") -> DataFrame:
    """Passes per checkpoint per window (traffic flow); tumbling when
    ``slide`` is None."""
    g = _pane_windows(traffic, window, slide or window, {"_n": ("1", "count")})
    return g.select("start_time", "end_time", "monitor_id", F.col("_n").cast("int").alias("car_count"))


def top_n_avg_speed(averages: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` fastest (most free-flowing) checkpoints of every window.

    Keeps the best row per checkpoint and window (a no-op after
    :func:`avg_speed`), then ranks by average speed descending, ties broken by
    ``monitor_id`` ascending; fewer than ``n`` rows when fewer checkpoints.
    The de-duplication reuses the partitioning of :func:`avg_speed`; the ranking
    is a group limit, so each task sends at most ``n`` rows per window.
    """
    best = Window.partitionBy("start_time", "end_time", "monitor_id").orderBy(F.desc("avg_speed"))
    dedup = (averages.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r"))
    rank = Window.partitionBy("start_time", "end_time").orderBy(F.desc("avg_speed"), "monitor_id")
    return (dedup.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= n)
                 .select("start_time", "end_time", "rank", "monitor_id", "avg_speed", "car_count"))


def top_n_text(top: DataFrame) -> DataFrame:
    """One alert line per window listing its ranked checkpoints."""
    item = F.concat(F.lit("卡口编号："), F.col("monitor_id"), F.lit("，平均车速："),
                    F.col("avg_speed").cast("string"), F.lit("，经过的车数量："),
                    F.col("car_count").cast("string"))
    g = top.groupBy("start_time", "end_time").agg(
        F.sort_array(F.collect_list(F.struct("rank", item.alias("t")))).alias("_items"))
    head = F.concat(F.lit("在时间从"), F.col("start_time").cast("string"), F.lit("，到:"),
                    F.col("end_time").cast("string"), F.lit("的时间范围内："),
                    F.lit("整个城市最通畅的前三个卡口为："))
    return g.select("start_time", "end_time",
                    F.concat(head, F.array_join(F.col("_items.t"), "")).alias("alert_text"))


def _area_text(n_col: str) -> F.Column:
    return F.concat(F.lit("区域id："), F.col("area_id"), F.lit("，时间范围为【起始时间："),
                    F.col("start_time").cast("string"), F.lit("----结束时间："),
                    F.col("end_time").cast("string"), F.lit("】，一共上路的车辆为"),
                    F.col(n_col).cast("string"))


def area_vehicles(traffic: DataFrame, window: str = "30 seconds", distinct: str = "car",
                  rsd: float = 0.02, lg_config_k: int = 12) -> DataFrame:
    """Distinct vehicles per area per tumbling window.

    ``distinct="car"`` — exact distinct cars (a two-phase distinct aggregate:
    rows are pre-deduplicated per (window, area, car) before the count);
    ``"record"`` — distinct whole pass records; ``"approx"`` — HyperLogLog++
    estimate with relative error ``rsd`` (fixed-size state, streaming friendly);
    ``"sketch"`` — the estimate plus the mergeable HLL sketch ``car_sketch``
    (``hll_union_agg`` combines sketches of several areas or windows).
    """
    t = _with_event_time(traffic)
    g = t.groupBy(F.window("event_time", window), "area_id")
    if distinct == "car":
        agg = F.count_distinct("car")
    elif distinct == "record":
        agg = F.count_distinct(F.struct(*[c for c in traffic.columns
                                          if c not in ("event_time", "seq")]))
    elif distinct == "approx":
        agg = F.approx_count_distinct("car", rsd)
    elif distinct == "sketch":
        # mergeable HLL sketches: union them later over areas or windows
        out = g.agg(F.hll_sketch_agg("car", lg_config_k).alias("car_sketch"))
        out = out.select(*window_bounds_ms(), "area_id",
                         F.hll_sketch_estimate("car_sketch").cast("int").alias("car_count"),
                         "car_sketch")
        return out.withColumn("alert_text", _area_text("car_count"))
    else:
        raise ValueError("distinct must be 'car', 'record', 'approx' or 'sketch'")
    out = g.agg(agg.cast("int").alias("car_count")).select(*window_bounds_ms(), "area_id",
                                                           "car_count")
    return out.withColumn("alert_text", _area_text("car_count"))


#: A chunk of 32,768 bits with at most so many set holds their offsets (2 bytes each); others hold 4 KiB of bits.
SPARSE_BITS = 2048


def containers(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks ``(keys, bucket, positions array<int>)`` as containers ``(keys, bucket, offsets, bits)``:
    sorted offsets where few bits are set, else the chunk's bits."""
    small = F.size("positions") <= SPARSE_BITS
    offsets = F.sort_array("positions")
    sparse = chunks.where(small).select(*keys, "bucket", offsets.alias("offsets"), F.lit(None).cast("binary").alias("bits"))
    dense = (chunks.where(~small).select(*keys, "bucket", F.explode("positions").alias("_p")).groupBy(*keys, "bucket")
             .agg(F.bitmap_construct_agg("_p").alias("bits"))
             .select(*keys, "bucket", F.lit(None).cast("array<int>").alias("offsets"), "bits"))
    return sparse.unionByName(dense)


def bitmap_count(bitmap: str | F.Column) -> F.Column:
    """Set bits of a bitmap: an array of containers (``offsets``, and ``bits`` where it has them)."""
    def size(x):
        return F.when(x["offsets"].isNotNull(), F.size(x["offsets"]).cast("long")).otherwise(F.bitmap_count(x["bits"]))
    return F.aggregate(bitmap, F.lit(0).cast("long"), lambda n, x: n + F.coalesce(size(x), F.lit(0).cast("long")))


def merge_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of rows with equal ``keys`` as one: ``(keys, bitmap)``.

    Offsets are joined as sets; where a chunk is dense on either side, its offsets become
    bits and are combined with the others.
    """
    c = bitmaps.select(*keys, F.explode("bitmap").alias("_c")).select(*keys, "_c.bucket", "_c.offsets", "_c.bits")
    dense = c.where("bits IS NOT NULL").select(*keys, "bucket", "bits")
    sparse = c.where("bits IS NULL").select(*keys, "bucket", F.explode("offsets").alias("_p"))
    at = [*keys, "bucket"]
    where_dense = dense.select(*at).distinct()
    raised = sparse.join(where_dense, at, "left_semi").groupBy(*at).agg(F.bitmap_construct_agg("_p").alias("bits"))
    both = dense.unionByName(raised).groupBy(*at).agg(F.bitmap_or_agg("bits").alias("bits"))
    lists = sparse.join(where_dense, at, "left_anti").groupBy(*at).agg(F.collect_set("_p").alias("positions"))
    merged = containers(lists, keys).unionByName(
        both.select(*at, F.lit(None).cast("array<int>").alias("offsets"), "bits"))
    return merged.groupBy(*keys).agg(F.collect_list(F.struct("bucket", "offsets", "bits")).alias("bitmap"))


def area_vehicles_bitmap(traffic: DataFrame, window: str = "30 seconds",
                         num_bits: int = 1 << 25, materialize: bool = False) -> DataFrame:
    """Distinct vehicles per area and window through a one-hash bitmap of
    ``num_bits`` bits: the number of set bits (equals the exact count unless
    two cars share a bit).

    The count of set bits is the number of distinct bit offsets, computed as a
    two-phase distinct aggregate over offsets (each task drops repeated
    offsets before the shuffle; at most ``num_bits`` values per group, so state
    is bounded by the bitmap size).  ``materialize=True`` also returns the bitmap
    itself as ``bitmap`` (array of ``struct(bucket, offsets, bits)``, see
    :func:`containers`), e.g. to export to a bitmap store or for
    :func:`merge_bitmaps`: positions are gathered per chunk of 32,768 bits,
    map-side first, so what is shuffled follows the bits that are set.
    """
    t = _with_event_time(traffic).withColumn("_o", bitmap_offset("car", num_bits))
    if not materialize:
        out = (t.groupBy(F.window("event_time", window), "area_id")
                .agg(F.count_distinct("_o").cast("int").alias("car_count"))
                .select(*window_bounds_ms(), "area_id", "car_count"))
        return out.withColumn("alert_text", _area_text("car_count"))
    chunks = (t.groupBy(F.window("event_time", window), "area_id", F.bitmap_bucket_number("_o").alias("bucket"))
               .agg(F.collect_set(F.bitmap_bit_position("_o").cast("int")).alias("positions")))
    out = (containers(chunks, ["window", "area_id"]).groupBy("window", "area_id")
           .agg(F.collect_list(F.struct("bucket", "offsets", "bits")).alias("bitmap"))
           .select(*window_bounds_ms(), "area_id", bitmap_count("bitmap").cast("int").alias("car_count"), "bitmap"))
    return out.withColumn("alert_text", _area_text("car_count"))


def area_vehicles_running(traffic: DataFrame, window_ms: int = 30_000,
                          bucket_ms: int = 1_000) -> DataFrame:
    """Running distinct-vehicle count per area and tumbling window, one row
    per pass in arrival order (a trigger that fires on every element).

    ``is_new`` marks the first pass of a car in its (area, window): the first
    ``(time, seq)`` per (area, window, car) is a two-phase aggregate joined
    back.  ``running_count`` is the running sum of ``is_new`` in ``(time,
    seq)`` order, computed by the bucketed ordered scan, so even a window
    holding a large share of all passes is split over tasks by
    ``bucket_ms`` time buckets.  A pass without car is never new; one without
    area or time has no window, so its flag and count are NULL.  ``seq`` is
    optional (:func:`with_unique_seq`).
    """
    start = F.col("action_time") - F.pmod(F.col("action_time"), F.lit(window_ms))
    t = with_unique_seq(traffic).withColumn("start_time", start)
    placed = t.where("area_id IS NOT NULL AND action_time IS NOT NULL")
    keys = ["area_id", "start_time", "car"]
    first = placed.where("car IS NOT NULL").groupBy(*keys).agg(F.min(F.struct("action_time", "seq")).alias("_first"))
    marked = placed.join(first, keys, "left").withColumn(
        "is_new", F.coalesce(F.struct("action_time", "seq") == F.col("_first"), F.lit(False))).drop("_first")
    marked = marked.withColumn("_new", F.col("is_new").cast("long"))
    s = ordered_scan(marked, ["area_id", "start_time"], "action_time", "seq", sums=["_new"],
                     bucket_ms=bucket_ms)
    end = (F.col("start_time") + F.lit(window_ms)).alias("end_time")
    names = ["area_id", "car", "action_time", "seq"]
    rest = t.where("area_id IS NULL OR action_time IS NULL")
    return s.select("start_time", end, *names, "is_new", F.col("_run__new").alias("running_count")).unionByName(
        rest.select("start_time", end, *names, F.lit(None).cast("boolean").alias("is_new"),
                    F.lit(None).cast("long").alias("running_count")))


def with_area_name(df: DataFrame, areas: DataFrame | None = None) -> DataFrame:
    """Left-join area names (the eight-row dictionary is broadcast)."""
    side = F.broadcast(area_names(df.sparkSession)) if areas is None else bounded_broadcast(areas)
    return df.join(side, "area_id", "left")
