"""Column expressions shared by batch and streaming operators (JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MAX = 2 ** 63 - 1


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(ms="action_time") -> Column:
    """Epoch-millisecond column → TIMESTAMP (time-zone independent instant)."""
    return F.timestamp_millis(_c(ms))


def epoch_ms(ts) -> Column:
    """TIMESTAMP → epoch milliseconds."""
    return F.unix_millis(_c(ts))


def window_bounds_ms(window_col: str = "window") -> list[Column]:
    """``window`` struct → ``start_time``, ``end_time`` in epoch ms."""
    w = F.col(window_col)
    return [F.unix_millis(w.start).alias("start_time"), F.unix_millis(w.end).alias("end_time")]


def micros(speed="speed") -> Column:
    """Speed as an integer number of millionths, so that sums are exact in any order."""
    return F.round(_c(speed) * F.lit(1_000_000)).cast("long")


def half_up_mean(total: Column, n: Column) -> Column:
    """Mean of values given as integer millionths, rounded HALF_UP to 2 decimals.

    Exact and independent of summation order: ``((2t + mn) div 2mn) / 100`` with
    ``m`` millionths to a hundredth.  NULL when ``n`` is 0.
    """
    per = F.nullif(n, F.lit(0)).cast("long") * F.lit(10_000)
    q = F.call_function("div", F.lit(2) * total + per, F.lit(2) * per)
    return q.cast("double") / F.lit(100)


def track_row_key(car="car", action_time="action_time") -> Column:
    """Newest-first row key ``car + "_" + (Long.MAX_VALUE - action_time)``.

    For every realistic millisecond time the suffix has 19 digits, so the
    lexicographic order of keys is car ascending, time descending.
    """
    return F.concat(_c(car), F.lit("_"), (F.lit(LONG_MAX) - _c(action_time)).cast("string"))


def bitmap_offset(value="car", num_bits: int = 1 << 25) -> Column:
    """Bit offset of ``value`` in a ``num_bits`` one-hash bitmap.

    64-bit hash, negative hashes folded by bitwise NOT, then modulo the size.
    (xxhash64 here; the offsets differ from other hash functions on purpose.)
    """
    h = F.xxhash64(_c(value))
    pos = F.when(h < 0, F.bitwise_not(h)).otherwise(h)
    return pos % F.lit(num_bits)


def with_detected_at(df, column: str = "detected_at"):
    """Add the processing time of detection (wall clock), next to the
    deterministic event-time stamps every alert already carries."""
    return df.withColumn(column, F.current_timestamp())


_UNITS_MS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000,
             "day": 86_400_000}


def duration_ms(d) -> int:
    """``"5 minutes"`` / ``"30 seconds"`` / int milliseconds → milliseconds."""
    if isinstance(d, int):
        return d
    n, unit = d.strip().split()
    unit = unit.lower().rstrip("s")
    return int(float(n) * _UNITS_MS[unit])
