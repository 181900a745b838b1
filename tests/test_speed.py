from conftest import traffic_df

from roadsight.operators.speed import out_of_speed, speeding, with_limit


def limits(spark, rows):
    return spark.createDataFrame(rows, "monitor_id string, road_id string, speed_limit int, area_id string")


def test_out_of_speed_strict_boundary(spark):
    lim = limits(spark, [("0000", "02", 60, "01"), ("0002", "03", 80, "01"), ("0004", "05", 100, "03")])
    t = traffic_df(spark, [(1, "0000", "a", 66.0), (2, "0002", "b", 88.0), (3, "0004", "c", 110.0),
                           (4, "0000", "d", 66.1), (5, "0003", "e", 300.0)])
    r = out_of_speed(t, lim).collect()
    assert [(x.car, x.limit_speed, x.real_speed, x.road_id) for x in r] == [("d", 60, 66.1, "001")]


def test_with_limit_default_and_speeding(spark):
    lim = limits(spark, [("0002", "03", 80, "01")])
    t = traffic_df(spark, [(1, "0002", "a", 96.0), (2, "0002", "b", 96.1), (3, "0009", "c", 96.1)])
    w = with_limit(t, lim)
    assert {x.car: x.limit_speed for x in w.collect()} == {"a": 80, "b": 80, "c": 80}
    assert sorted(x.car for x in speeding(w, 1.2).collect()) == ["b", "c"]


def test_broadcast_only_when_bounded(spark):
    lim = limits(spark, [("0002", "03", 80, "01")])
    t = traffic_df(spark, [(1, "0002", "a", 96.0)])
    small = out_of_speed(t, lim, 0.0, max_broadcast_rows=10)
    big = out_of_speed(t, lim, 0.0, max_broadcast_rows=0)
    plan_small = small._jdf.queryExecution().optimizedPlan().toString()
    plan_big = big._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan_small.lower() and "broadcast" not in plan_big.lower()


def test_broadcast_bound_from_session(spark):
    lim = limits(spark, [("0002", "03", 80, "01"), ("0003", "03", 80, "01")])
    t = traffic_df(spark, [(1, "0002", "a", 96.0)])
    spark.conf.set("spark.roadsight.broadcastMaxRows", "1")
    try:
        plan = out_of_speed(t, lim, 0.0)._jdf.queryExecution().optimizedPlan().toString()
        assert "broadcast" not in plan.lower()
    finally:
        spark.conf.unset("spark.roadsight.broadcastMaxRows")
    plan = out_of_speed(t, lim, 0.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan.lower()
