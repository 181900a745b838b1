"""Traffic model derived from the driver's generic tables.

Every view reads a whole driver table, so its size grows with the scale
factor.  The same mapping is given twice: as Spark DataFrames (used by the
queries) and as DuckDB SQL (used by the oracle in ``__spark_entry__``).

* passes      ← ``events`` (all rows).  Event times span 30 days; they are
  compressed by 1000× around 2024-01-01 so second-scale rules fire.
* limits feed ← ``part`` (all rows), several loads per checkpoint ordered by
  ``load_seq``; the current dimension is the latest load per checkpoint.
* watch list  ← ``customer`` (all rows).
* violations  ← ``events`` of type ``error``; police actions ← type ``purchase``.
* daily reports ← ``events`` of type ``signup`` (new) and ``view`` (stored),
  with uncompressed times so that several days occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsight.sources.dims import latest_by_key, valid_limits

BASE_MS = 1704067200000   # 2024-01-01T00:00:00Z
COMPRESSION = 1000
PLATE_PREFIX = "京A"


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the DataFrame (file listing and footers) is reused
    within a session since the driver tables are read-only."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = _TABLES.get(path)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[path] = spark.read.parquet(path)
    return df


def _epoch_ms(df: DataFrame, col: str = "ts") -> Column:
    if dict(df.dtypes)[col] == "timestamp_ntz":
        micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})")
    else:
        micros = F.unix_micros(F.col(col))
    # Truncate to the millisecond (the oracle uses epoch_us(ts) // 1000 too).
    return F.call_function("div", micros, F.lit(1000))


def _compressed_ms(df: DataFrame) -> Column:
    return F.lit(BASE_MS) + F.call_function("div", _epoch_ms(df) - F.lit(BASE_MS),
                                            F.lit(COMPRESSION))


def _plate(id_col: str) -> Column:
    number = F.col(id_col).cast("string")  # padded to five characters, never cut
    return F.concat(F.lit(PLATE_PREFIX), F.when(F.length(number) < 5, F.lpad(number, 5, "0")).otherwise(number))


def passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle passes: traffic columns plus ``seq`` (arrival order)."""
    ev = table(spark, sf_dir, "events")
    monitor = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 50
    return ev.select(
        _compressed_ms(ev).alias("action_time"),
        F.lpad(monitor.cast("string"), 4, "0").alias("monitor_id"),
        F.lpad((F.col("event_id") % 100000).cast("string"), 5, "0").alias("camera_id"),
        _plate("user_id").alias("car"),
        F.col("value").alias("speed"),
        F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0").alias("road_id"),
        F.lpad((F.col("event_id") % 8).cast("string"), 2, "0").alias("area_id"),
        F.col("event_id").alias("seq"),
    )


def traffic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passes rendered as the comma-separated text format (``value`` column)."""
    p = passes(spark, sf_dir)
    return p.select(F.concat_ws(",", *[F.col(c).cast("string") for c in
                                       ["action_time", "monitor_id", "camera_id", "car", "speed",
                                        "road_id", "area_id"]]).alias("value"))


def violation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations(spark, sf_dir).select(F.concat_ws(",", "car", "violation", "create_time").alias("value"))


def police_action_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return police_actions(spark, sf_dir).select(
        F.concat_ws(",", "police_id", "car", "action_status", "action_time").alias("value"))


def limits_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loads of the checkpoint table (``load_seq`` orders the loads)."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.lpad((F.col("p_partkey") % 50).cast("string"), 4, "0").alias("monitor_id"),
        F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0").alias("road_id"),
        ((F.col("p_size") % 6) * 20).cast("int").alias("speed_limit"),
        F.lpad((F.col("p_partkey") % 8).cast("string"), 2, "0").alias("area_id"),
        F.col("p_partkey").alias("load_seq"),
    )


def limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current limits: rows with a real limit, latest load per checkpoint."""
    # The source filter comes first (as in a WHERE on the table), then the
    # latest load per checkpoint wins.
    feed = limits_feed(spark, sf_dir).filter(F.col("speed_limit") > 0)
    return valid_limits(latest_by_key(feed, "monitor_id", "load_seq"))


def watch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed cars: suspected cloned plates (negative balance) or a count of
    unhandled violations (balance / 20)."""
    c = table(spark, sf_dir, "customer")
    count = F.floor(F.col("c_acctbal") / F.lit(20)).cast("int")
    violation = F.when(F.col("c_acctbal") < 0, F.lit("嫌疑套牌车")).otherwise(
        F.concat(F.lit("违章未处理超过"), count.cast("string"), F.lit("次")))
    return c.select(
        _plate("c_custkey").alias("car"),
        violation.alias("violation"),
        F.lit(None).cast("long").alias("create_time"),
        F.lit(0).alias("out_count"),
    )


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.filter(F.col("event_type") == "error").select(
        _plate("user_id").alias("car"),
        F.when(F.col("value") >= 50, F.lit("涉嫌套牌车")).otherwise(F.lit("超速行驶")).alias("violation"),
        _compressed_ms(ev).alias("create_time"),
        F.lit(0).alias("out_count"),
        F.col("event_id").alias("seq"),
    )


def police_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.filter(F.col("event_type") == "purchase").select(
        F.concat(F.lit("J"), F.lpad((F.col("event_id") % 10000).cast("string"), 4, "0")).alias("police_id"),
        _plate("user_id").alias("car"),
        F.when(F.col("value") >= 50, F.lit("处理完成")).otherwise(F.lit("处理中")).alias("action_status"),
        _compressed_ms(ev).alias("action_time"),
        F.col("event_id").alias("seq"),
    )


def daily_reports(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """Dangerous-driving reports with real (uncompressed) times."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return ev.filter(F.col("event_type") == event_type).select(
        _plate("user_id").alias("car"),
        F.concat(F.lit("危险驾驶"), k.cast("string")).alias("violation"),
        _epoch_ms(ev).alias("create_time"),
        (k % 10 + 1).cast("int").alias("out_count"),
    )


# ---------------------------------------------------------------- DuckDB twins
_EPOCH_MS_SQL = "(epoch_us(ts) // 1000)"
_COMPRESSED_SQL = f"({BASE_MS} + ({_EPOCH_MS_SQL} - {BASE_MS}) // {COMPRESSION})"
_PLATE_SQL = "('" + PLATE_PREFIX + "' || lpad(cast({c} as varchar), cast(greatest(5, length(cast({c} as varchar))) as integer), '0'))"

SQL_VIEWS = {
    "passes": f"""
        SELECT {_COMPRESSED_SQL} AS action_time,
               lpad(cast(cast(regexp_extract(props, '([0-9]+)', 1) as integer) % 50 as varchar), 4, '0') AS monitor_id,
               lpad(cast(event_id % 100000 as varchar), 5, '0') AS camera_id,
               {_PLATE_SQL.format(c='user_id')} AS car,
               value AS speed,
               lpad(cast(event_id % 1000 as varchar), 3, '0') AS road_id,
               lpad(cast(event_id % 8 as varchar), 2, '0') AS area_id,
               event_id AS seq
        FROM events""",
    "limits_feed": """
        SELECT lpad(cast(p_partkey % 50 as varchar), 4, '0') AS monitor_id,
               lpad(cast(p_partkey % 1000 as varchar), 3, '0') AS road_id,
               cast((p_size % 6) * 20 as integer) AS speed_limit,
               lpad(cast(p_partkey % 8 as varchar), 2, '0') AS area_id,
               p_partkey AS load_seq
        FROM part""",
    "limits": """
        SELECT monitor_id, road_id, speed_limit, area_id FROM (
          SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY load_seq DESC) AS rn
          FROM limits_feed WHERE speed_limit > 0) WHERE rn = 1""",
    "watch_list": f"""
        SELECT {_PLATE_SQL.format(c='c_custkey')} AS car,
               CASE WHEN c_acctbal < 0 THEN '嫌疑套牌车'
                    ELSE '违章未处理超过' || cast(cast(floor(c_acctbal / 20) as integer) as varchar) || '次' END AS violation,
               cast(NULL as bigint) AS create_time,
               0 AS out_count
        FROM customer""",
    "violations": f"""
        SELECT {_PLATE_SQL.format(c='user_id')} AS car,
               CASE WHEN value >= 50 THEN '涉嫌套牌车' ELSE '超速行驶' END AS violation,
               {_COMPRESSED_SQL} AS create_time, 0 AS out_count, event_id AS seq
        FROM events WHERE event_type = 'error'""",
    "police_actions": f"""
        SELECT 'J' || lpad(cast(event_id % 10000 as varchar), 4, '0') AS police_id,
               {_PLATE_SQL.format(c='user_id')} AS car,
               CASE WHEN value >= 50 THEN '处理完成' ELSE '处理中' END AS action_status,
               {_COMPRESSED_SQL} AS action_time, event_id AS seq
        FROM events WHERE event_type = 'purchase'""",
    "reports_new": f"""
        SELECT {_PLATE_SQL.format(c='user_id')} AS car,
               '危险驾驶' || regexp_extract(props, '([0-9]+)', 1) AS violation,
               {_EPOCH_MS_SQL} AS create_time,
               cast(cast(regexp_extract(props, '([0-9]+)', 1) as integer) % 10 + 1 as integer) AS out_count
        FROM events WHERE event_type = 'signup'""",
    "reports_old": f"""
        SELECT {_PLATE_SQL.format(c='user_id')} AS car,
               '危险驾驶' || regexp_extract(props, '([0-9]+)', 1) AS violation,
               {_EPOCH_MS_SQL} AS create_time,
               cast(cast(regexp_extract(props, '([0-9]+)', 1) as integer) % 10 + 1 as integer) AS out_count
        FROM events WHERE event_type = 'view'""",
}


def sql_with(*views: str) -> str:
    """``WITH`` clause defining the requested views (and what they depend on)."""
    deps = {"limits": ["limits_feed"]}
    order: list[str] = []
    for v in views:
        for d in deps.get(v, []) + [v]:
            if d not in order:
                order.append(d)
    return "WITH " + ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in order) + "\n"
