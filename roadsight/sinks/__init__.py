"""Sinks (K1–K6): JDBC appends, daily upsert, keyed track table, console alerts."""

from roadsight.sinks.writers import (  # noqa: F401
    SPEEDING_TABLE_COLUMNS, AVERAGE_SPEED_TABLE_COLUMNS, VIOLATION_TABLE_COLUMNS, alert_console,
    read_tracks, upsert_daily_violations, upsert_daily_violations_stream, write_jdbc,
    write_jdbc_stream, write_tracks,
)
