"""Plan-shape regressions: pushdown, pruning, no row expansion, bucketed keys."""

from conftest import SF_SMALL

import __spark_entry__ as E

Q = E.queries()


def physical(spark, name):
    return Q[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_filters_pushed_and_columns_pruned(spark):
    plan = physical(spark, "violation_action_interval")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "EqualTo(event_type,purchase)" in plan
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert scans and all("props" not in line for line in scans)   # unused column not read
    plan = physical(spark, "car_track")
    assert "c_mktsegment" not in plan     # the list is the whole table, two columns of it


def test_sliding_average_does_not_expand_raw_rows(spark):
    plan = physical(spark, "avg_speed_sliding")
    assert "Expand" not in plan          # panes: raw rows are aggregated once
    assert "HashAggregate" in plan


def test_interval_join_keys_include_time_bucket(spark):
    df = Q["violation_action_interval"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_rb" in plan                  # equi-join on (car, bucket), not car alone


def test_no_cross_products(spark):
    for name in ("violation_action_full", "track_batches", "dangerous_car_all", "pair_violation_action"):
        plan = physical(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
