"""Comma-separated line sources (files, Kafka values, socket values).

A traffic line is ``action_time,monitor_id,camera_id,car,speed,road_id,area_id``;
fields after the seventh are ignored.  ``mode="strict"`` fails the job on a
short or non-numeric line, ``mode="permissive"`` yields NULLs and keeps the raw
line in ``_corrupt_record``.  Parsing is pure column expressions, so it runs
inside whole-stage codegen on batch and streaming frames alike.  The split line is
the output of a one-row generator: later expressions refer to it as a column, so
no optimizer rule repeats the split, or the expressions that build the line, a field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadsight import schemas


def _strict_cast(raw: Column, dtype: str) -> Column:
    # Fails on non-numeric text whatever spark.sql.ansi.enabled says.
    parsed = raw.try_cast(dtype)
    err = F.raise_error(F.concat(F.lit(f"cannot parse {dtype}: "), raw)).cast(dtype)
    return F.when(raw.isNotNull() & parsed.isNull(), err).otherwise(parsed)


def _parse(lines: DataFrame, col: str, schema: T.StructType, mode: str) -> DataFrame:
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode must be 'strict' or 'permissive', got {mode!r}")
    strict = mode == "strict"
    lines = lines.select(col, F.explode(F.array(F.split(F.col(col), ","))).alias("_parts"))
    parts = F.col("_parts")
    n = len(schema.fields)
    short = F.size(parts) < n
    out, bad = [], short
    for i, f in enumerate(schema.fields):
        raw = F.try_element_at(parts, F.lit(i + 1))
        dt = f.dataType.simpleString()
        if dt == "string":
            val = raw
        elif strict:
            val = _strict_cast(raw, dt)
        else:
            val = raw.try_cast(dt)
        out.append(val.alias(f.name))
        if dt != "string":
            bad = bad | (raw.isNotNull() & raw.try_cast(dt).isNull())
    if strict:
        # a filter, as column pruning would remove checks that hang on single columns
        wrong = F.raise_error(F.concat(F.lit("malformed line: "), F.col(col))).cast("boolean")
        return lines.where(F.when(F.coalesce(bad, F.lit(False)), wrong).otherwise(F.lit(True))).select(*out)
    return lines.select(*out, F.when(bad, F.col(col)).alias("_corrupt_record"))


def parse_traffic(lines: DataFrame, col: str = "value", mode: str = "strict") -> DataFrame:
    """CSV line column → traffic columns (batch or streaming)."""
    return _parse(lines, col, schemas.TRAFFIC, mode)


def parse_violation(lines: DataFrame, col: str = "value", mode: str = "strict") -> DataFrame:
    """``car,violation,create_time`` lines; ``out_count`` starts at 0."""
    three = T.StructType(schemas.VIOLATION.fields[:3])
    return _parse(lines, col, three, mode).withColumn("out_count", F.lit(0))


def parse_police_action(lines: DataFrame, col: str = "value", mode: str = "strict") -> DataFrame:
    """``police_id,car,action_status,action_time`` lines."""
    return _parse(lines, col, schemas.POLICE_ACTION, mode)


def _read(spark: SparkSession, path: str, parse, mode: str) -> DataFrame:
    return parse(spark.read.text(path), "value", mode)


def _stream(spark: SparkSession, source: str, path: str | None, parse, mode: str, options: dict) -> DataFrame:
    reader = spark.readStream.format(source).options(**options)
    if source == "kafka":
        lines = reader.load().select(F.col("value").cast("string").alias("value"))
    else:
        lines = reader.load(path)
    return parse(lines, "value", mode)


def read_traffic(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Bounded scan of traffic text files (one pass per line, splittable)."""
    return _read(spark, path, parse_traffic, mode)


def read_violations(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Bounded scan of violation text files."""
    return _read(spark, path, parse_violation, mode)


def read_police_actions(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Bounded scan of police-action text files."""
    return _read(spark, path, parse_police_action, mode)


def stream_traffic(spark: SparkSession, source: str = "text", path: str | None = None,
                   mode: str = "strict", **options) -> DataFrame:
    """Unbounded traffic scan.

    ``source="text"`` watches a folder of line files (pass ``maxFilesPerTrigger``
    etc. as options); ``source="kafka"`` subscribes to a topic (needs the Kafka
    connector on the classpath, e.g. ``subscribe="traffic"``,
    ``startingOffsets="earliest"``).  Either way the line is parsed by
    :func:`parse_traffic`.
    """
    return _stream(spark, source, path, parse_traffic, mode, options)


def stream_violations(spark: SparkSession, source: str = "text", path: str | None = None,
                      mode: str = "strict", **options) -> DataFrame:
    """Unbounded scan of violation lines (sources as in :func:`stream_traffic`)."""
    return _stream(spark, source, path, parse_violation, mode, options)


def stream_police_actions(spark: SparkSession, source: str = "text", path: str | None = None,
                          mode: str = "strict", **options) -> DataFrame:
    """Unbounded scan of police-action lines (sources as in :func:`stream_traffic`)."""
    return _stream(spark, source, path, parse_police_action, mode, options)
