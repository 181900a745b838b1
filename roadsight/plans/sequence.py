"""Ordered per-key scans that stay parallel when one key is huge.

Keyed state machines (cloned plates, violation/police pairing, running
distinct counts) need, for every row, facts about its neighbours in the
key's time order: the previous and next row, its position, where its
"island" started, running sums.  ``Window.partitionBy(key)`` computes this
but sends all rows of a key to one task, which fails when a single key holds
a large share of the data.

:func:`ordered_scan` splits each key into buckets and works in two levels:

1. rows are windowed per ``(key, bucket)`` (bounded work per task): local
   position, local neighbours, local running values;
2. one summary row per ``(key, bucket)`` (count, first and last row, local
   facts) is scanned per key ordered by bucket — this is tiny, one row per
   bucket — and joined back to supply what crosses bucket borders:
   the position offset, the neighbour across the border, the island start
   carried in from earlier buckets and the running values of earlier buckets.

The result equals the single-window formulation exactly (tests compare it
with sequential folds), and no task ever holds more than one key's bucket.
Expressions are written as SQL text (``selectExpr``): a handful of calls
into the JVM per step instead of one per column node.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Accessor = Callable[[str], str]
# rule(prev, cur) -> SQL boolean text; prev("t") / cur("t") give column references
IslandRule = Callable[[Accessor, Accessor], str]

DEFAULT_BUCKET_MS = 10 * 60 * 1000
_UNIT, _NONE = "\x1f", "\x00"   # between columns; in place of NULL


def _q(name: str) -> str:
    return f"`{name}`"


def _record_text(columns: Sequence[str]) -> Column:
    return F.concat_ws(_UNIT, *[F.coalesce(F.col(_q(c)).cast("string"), F.lit(_NONE)) for c in columns])


def with_seq(df: DataFrame) -> DataFrame:
    """``df`` with a column ``seq`` that orders records of the same time.

    A ``seq`` that the source gives (arrival number, offset) stays.  Otherwise it
    is the text of all record columns in their order: a total order up to exact
    duplicates, which are interchangeable, and the same on batch and stream.
    """
    if "seq" in df.columns:
        return df
    return df.withColumn("seq", _record_text(df.columns))


def with_unique_seq(df: DataFrame) -> DataFrame:
    """Like :func:`with_seq`, but exact duplicates are numbered, so each row's ``seq`` is its own.

    Duplicates are counted map-side before the shuffle, so many of them cost one row per task.
    """
    if "seq" in df.columns:
        return df
    copies = df.groupBy(*[_q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    rows = copies.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    number = F.lpad(F.col("_n").cast("string"), 19, "0")
    return rows.select(*[F.col(_q(c)) for c in df.columns],
                       F.concat_ws(_UNIT, _record_text(df.columns), number).alias("seq"))


def ordered_scan(df: DataFrame, key: Sequence[str], ts: str, tiebreak: str,
                 carry: Sequence[str] = (), new_island: IslandRule | None = None,
                 sums: Sequence[str] = (), maxes: Sequence[str] = (),
                 bucket_ms: int = DEFAULT_BUCKET_MS, split: str = "time",
                 partitions: int | None = None) -> DataFrame:
    """Add order facts to every row of ``df``.

    Rows of one key are ordered by ``(ts, tiebreak)`` (``tiebreak`` unique per
    key); rows with a NULL key or time are dropped (they have no place in a
    keyed time order).  Added columns:

    * ``_pos``  — 1-based position within the key;
    * ``prev_<c>``, ``next_<c>`` for ``c`` in ``carry`` (+ ``ts``, ``tiebreak``);
    * with ``new_island(prev, cur)`` — a SQL boolean over the previous and the
      current row, e.g. ``lambda p, c: f"{c('t')} - {p('t')} > 5000"``; the
      first row of a key always starts an island: ``_is_start``, ``_start``
      (position of the island's first row) and ``_next_is_start`` (true when
      the next row starts an island or there is no next row);
    * ``_run_<s>`` — running sum of column ``s`` up to and including the row;
    * ``_max_<m>`` — running maximum of column ``m`` over the rows *before*
      the row (NULL for the first row).

    ``key`` may be empty (one ordered sequence over the whole table).

    ``split="time"`` (default) buckets by ``floor(ts / bucket_ms)``: no extra
    pass, and a hot key is spread over its time range.  ``split="range"``
    range-partitions by ``(key, ts, tiebreak)`` instead — Spark samples the
    data, so even rows piled on one timestamp are cut into balanced runs —
    and uses the partition id as bucket; the partitioned data is checkpointed
    (reliable, under ``spark.checkpoint.dir``) so that ids cannot change if a
    task is recomputed.
    """
    key = list(key)
    cols = list(dict.fromkeys([ts, tiebreak, *carry]))
    keys = ", ".join(_q(k) for k in key)
    valid = " AND ".join(f"{_q(c)} IS NOT NULL" for c in [ts, *key])

    # Filtering NULLs here also gives both branches below the same plan, so
    # the row shuffle is computed once and reused by the summary branch.
    if split == "time":
        rows = df.where(valid).selectExpr(
            "*", f"CAST(FLOOR({_q(ts)} / {int(bucket_ms)}) AS BIGINT) AS _bucket")
    elif split == "range":
        from roadsight.session import checkpoint_root
        checkpoint_root(df.sparkSession)
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = (df.where(valid).repartitionByRange(n, *key, ts, tiebreak)
                  .withColumn("_bucket", F.spark_partition_id().cast("long"))
                  .checkpoint(eager=True))
    else:
        raise ValueError("split must be 'time' or 'range'")
    rows = rows.where("_bucket IS NOT NULL")

    part = f"PARTITION BY {keys + ', ' if key else ''}_bucket"
    order = f"ORDER BY {_q(ts)}, {_q(tiebreak)}"
    w = f"OVER ({part} {order})"
    upto = f"OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before_row = f"OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    local = ["*", f"row_number() {w} AS _li"]
    local += [f"lag({_q(c)}) {w} AS `_lp_{c}`" for c in cols]
    local += [f"lead({_q(c)}) {w} AS `_ln_{c}`" for c in cols]
    local += [f"sum({_q(s)}) {upto} AS `_lr_{s}`" for s in sums]
    local += [f"max({_q(m)}) {before_row} AS `_lm_{m}`" for m in maxes]
    rows = rows.selectExpr(*local)

    if new_island is not None:
        lflag = new_island(lambda c: f"`_lp_{c}`", _q)
        nflag = new_island(_q, lambda c: f"`_ln_{c}`")
        rows = rows.selectExpr(
            "*", f"(`_lp_{ts}` IS NOT NULL AND ({lflag})) AS _lflag",
            f"(`_ln_{ts}` IS NOT NULL AND ({nflag})) AS _nflag")
        rows = rows.selectExpr("*", f"max(CASE WHEN _lflag THEN _li END) {upto} AS _lstart")

    # ---- level 2: one row per (key, bucket), scanned per key by bucket
    packed = "struct(" + ", ".join(_q(c) for c in cols) + ")"
    aggs = ["count(1) AS _cnt", f"min_by({packed}, _li) AS _first",
            f"max_by({packed}, _li) AS _last"]
    aggs += [f"sum({_q(s)}) AS `_bt_{s}`" for s in sums]
    aggs += [f"max({_q(m)}) AS `_bm_{m}`" for m in maxes]
    if new_island is not None:
        aggs.append("max(CASE WHEN _lflag THEN _li END) AS _bstart")
    summary = rows.groupBy(*key, "_bucket").agg(*[F.expr(a) for a in aggs])

    kp = f"PARTITION BY {keys}" if key else ""
    kw = f"OVER ({kp} ORDER BY _bucket)"
    before = f"OVER ({kp} ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    level2 = [*[_q(k) for k in key], "_bucket", "_cnt", "_first", "_last",
              f"coalesce(sum(_cnt) {before}, 0) AS _off",
              f"lag(_last) {kw} AS _pb", f"lead(_first) {kw} AS _nb"]
    level2 += [f"coalesce(sum(`_bt_{s}`) {before}, 0) AS `_bo_{s}`" for s in sums]
    level2 += [f"max(`_bm_{m}`) {before} AS `_bx_{m}`" for m in maxes]
    if new_island is not None:
        level2.append("_bstart")
    summary = summary.selectExpr(*level2)
    if new_island is not None:
        fstart = new_island(lambda c: f"_pb.`{c}`", lambda c: f"_first.`{c}`")
        nfstart = new_island(lambda c: f"_last.`{c}`", lambda c: f"_nb.`{c}`")
        summary = summary.selectExpr(
            "*", f"(_pb IS NULL OR ({fstart})) AS _fstart",
            f"(_nb IS NULL OR ({nfstart})) AS _nfstart")
        summary = summary.selectExpr(
            "*", "_off + coalesce(_bstart, CASE WHEN _fstart THEN 1 END) AS _bstart_g")
        summary = summary.selectExpr("*", f"max(_bstart_g) {before} AS _carry")
    summary = summary.drop("_first", "_last", "_bstart", "_bstart_g")

    out = rows.join(summary, [*key, "_bucket"], "inner")
    final = [_q(c) for c in df.columns] + ["_off + _li AS _pos"]
    for c in cols:
        final.append(f"CASE WHEN _li = 1 THEN _pb.`{c}` ELSE `_lp_{c}` END AS `prev_{c}`")
        final.append(f"CASE WHEN _li = _cnt THEN _nb.`{c}` ELSE `_ln_{c}` END AS `next_{c}`")
    final += [f"`_bo_{s}` + `_lr_{s}` AS `_run_{s}`" for s in sums]
    final += [f"greatest(`_bx_{m}`, `_lm_{m}`) AS `_max_{m}`" for m in maxes]
    if new_island is not None:
        final += ["CASE WHEN _li = 1 THEN _fstart ELSE _lflag END AS _is_start",
                  "CASE WHEN _lstart IS NOT NULL THEN _off + _lstart "
                  "WHEN _fstart THEN _off + 1 ELSE _carry END AS _start",
                  "CASE WHEN _li = _cnt THEN _nfstart ELSE _nflag END AS _next_is_start"]
    return out.selectExpr(*final)
