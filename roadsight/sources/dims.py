"""Dimension sources: checkpoint limits, watch list, area names.

Dimensions can come from any DataFrame source (parquet, JDBC, ...).  Filters
are written as DataFrame filters so Catalyst pushes them into the scan (JDBC
``WHERE``, parquet row-group statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsight import schemas


def _load(spark: SparkSession, path: str | None, fmt: str, jdbc: dict | None, table: str,
          schema) -> DataFrame:
    if jdbc is not None:
        opts = dict(jdbc)
        opts.setdefault("dbtable", table)
        return spark.read.format("jdbc").options(**opts).load()
    reader = spark.read.format(fmt)
    if fmt in ("csv", "json"):
        reader = reader.schema(schema)
    return reader.load(path)


def valid_limits(limits: DataFrame) -> DataFrame:
    """Checkpoints with a real limit (``speed_limit > 0``)."""
    return limits.filter(F.col("speed_limit") > 0).select("monitor_id", "road_id", "speed_limit",
                                                           "area_id")


def read_monitor_limits(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                        jdbc: dict | None = None, table: str = "t_monitor_info") -> DataFrame:
    """Checkpoint speed limits; rows with limit 0 mean "no limit" and are dropped."""
    return valid_limits(_load(spark, path, fmt, jdbc, table, schemas.MONITOR_LIMIT))


def read_violation_list(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                        jdbc: dict | None = None, table: str = "t_violation_list") -> DataFrame:
    """Watch list of cars (``car, violation, create_time, out_count``).

    ``out_count`` is added as 0 when the source lacks it; NULL times stay NULL.
    """
    df = _load(spark, path, fmt, jdbc, table, schemas.VIOLATION)
    if "out_count" not in df.columns:
        df = df.withColumn("out_count", F.lit(0))
    return df.select("car", "violation", F.col("create_time").cast("long"),
                     F.col("out_count").cast("int"))


def latest_by_key(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """Last row per key by ``order`` (a refreshed dimension: later loads win,
    keys missing from a later load keep their earlier row).

    ``max_by`` is a two-phase aggregate: each task keeps one row per key before
    the shuffle, so a key repeated in every load cannot overload one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys)
              .agg(F.max_by(packed, F.col(order)).alias("_row"))
              .select(*keys, *[F.col("_row")[c].alias(c) for c in rest]))


# The area dictionary of the data model (area_id, area_name).
AREA_NAMES = [
    ("01", "海淀区"),
    ("02", "昌平区"),
    ("03", "朝阳区"),
    ("04", "顺义区"),
    ("05", "西城区"),
    ("06", "东城区"),
    ("07", "大兴区"),
    ("08", "石景山"),
]


def area_names(spark: SparkSession) -> DataFrame:
    """The eight-row area dictionary."""
    return spark.createDataFrame(AREA_NAMES, schemas.AREA)
