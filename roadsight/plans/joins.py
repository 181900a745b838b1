"""Join helpers whose plans survive growth of either side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bound for inputs of unknown size; see bounded_broadcast.
DEFAULT_BROADCAST_ROWS = 1_000_000
# Session setting that asks for a counted bound (executor memory decides what is safe).
BROADCAST_ROWS_CONF = "spark.roadsight.broadcastMaxRows"


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    ``limit(max_rows + 1).count()`` stops reading after ``max_rows + 1`` rows,
    so the check costs O(max_rows) whatever the size of ``df``.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def size_known(df: DataFrame) -> bool:
    """True when Catalyst knows the size of all that ``df`` reads (tables and files, not rows of
    the program or a JDBC table).  Planning only, no job."""
    default = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return all(int(str(leaves.apply(i).stats().sizeInBytes())) < default for i in range(leaves.size()))


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``df``, with a broadcast hint where its size was asked to be counted and is small.

    A side whose size Catalyst can estimate gets no hint and costs no job: the planner's
    threshold and AQE's runtime sizes choose the join.  Rows are counted (at most the bound)
    only where ``max_rows`` or the session setting ``spark.roadsight.broadcastMaxRows`` asks
    for it, or where nothing is known of the size (bound 1,000,000 rows)."""
    if df.isStreaming:
        return df
    if max_rows is None:
        asked = df.sparkSession.conf.get(BROADCAST_ROWS_CONF, None)
        if asked is None and size_known(df):
            return df
        max_rows = DEFAULT_BROADCAST_ROWS if asked is None else int(asked)
    return F.broadcast(df) if fits(df, max_rows) else df


def range_join(left: DataFrame, right: DataFrame, key: str, lt: str, rt: str,
               lower_ms: int, upper_ms: int, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` plus ``left[lt] + lower <= right[rt] <= left[lt] + upper``.

    A plain equi-join on ``key`` would put every row of a hot key into one
    task and compare all its pairs.  Both sides are cut into time buckets of
    width ``upper - lower``; the right row lives in one bucket and the left row
    is copied into the (at most two) buckets its interval touches, so every
    matching pair meets exactly once and a join task only sees rows of one key
    within two bucket widths.  ``right`` columns must not collide with
    ``left`` columns except ``key``.
    """
    width = max(upper_ms - lower_ms, 1)
    rb = F.floor(F.col(rt) / F.lit(width)).cast("long")
    r = right.withColumn("_rb", rb)
    lo = F.floor((F.col(lt) + F.lit(lower_ms)) / F.lit(width)).cast("long")
    hi = F.floor((F.col(lt) + F.lit(upper_ms)) / F.lit(width)).cast("long")
    lft = left.withColumn("_rb", F.explode(F.sequence(lo, hi)))
    cond = ((lft[key] == r[key]) & (lft["_rb"] == r["_rb"])
            & (r[rt] >= lft[lt] + F.lit(lower_ms)) & (r[rt] <= lft[lt] + F.lit(upper_ms)))
    joined = lft.join(r, cond, how)
    return joined.drop(r[key]).drop(lft["_rb"]).drop(r["_rb"])
