from conftest import traffic_df

from roadsight.operators.flow import (
    area_vehicles, area_vehicles_bitmap, area_vehicles_running, avg_speed, top_n_avg_speed,
)
from roadsight.functions.exprs import bitmap_offset


def test_sliding_membership(spark):
    r = avg_speed(traffic_df(spark, [(60_000, "0001", "a", 50.0)])).collect()
    assert sorted(x.start_time for x in r) == [-180_000, -120_000, -60_000, 0, 60_000]
    assert all(x.end_time - x.start_time == 300_000 for x in r)


def test_half_up_average_and_pass_count(spark):
    r = avg_speed(traffic_df(spark, [(1, "0001", "a", 2.67), (2, "0001", "a", 2.68)])).collect()
    assert {x.avg_speed for x in r} == {2.68} and {x.car_count for x in r} == {2}


def test_top_n_fewer_and_ties(spark):
    t = traffic_df(spark, [(1, "0003", "a", 50.0), (2, "0001", "b", 50.0), (3, "0002", "c", 50.0),
                           (4, "0004", "d", 40.0)])
    top = top_n_avg_speed(avg_speed(t), 3).filter("start_time = 0").orderBy("rank").collect()
    assert [x.monitor_id for x in top] == ["0001", "0002", "0003"]
    two = traffic_df(spark, [(1, "0001", "a", 50.0), (2, "0002", "b", 60.0)])
    assert top_n_avg_speed(avg_speed(two), 3).filter("start_time = 0").count() == 2


def test_area_distinct_car_vs_record(spark):
    t = traffic_df(spark, [(1, "0001", "a", 50.0), (2, "0001", "a", 50.0), (29_999, "0001", "b", 50.0),
                           (30_000, "0001", "b", 50.0)]).drop("seq")
    cars = {(x.start_time, x.car_count) for x in area_vehicles(t, distinct="car").collect()}
    recs = {(x.start_time, x.car_count) for x in area_vehicles(t, distinct="record").collect()}
    assert cars == {(0, 2), (30_000, 1)} and recs == {(0, 3), (30_000, 1)}
    text = area_vehicles(t).filter("start_time = 0").first().alert_text
    assert text == "区域id：01，时间范围为【起始时间：0----结束时间：30000】，一共上路的车辆为2"


def test_bitmap_offsets_in_range_and_count(spark):
    t = traffic_df(spark, [(i, "0001", f"car{i % 7}", 50.0) for i in range(50)])
    offs = [x.o for x in t.select(bitmap_offset("car", 1 << 25).alias("o")).collect()]
    assert all(0 <= o < (1 << 25) for o in offs)
    assert area_vehicles_bitmap(t).first().car_count == 7


def test_running_distinct(spark):
    t = traffic_df(spark, [(1, "0001", "a", 50.0), (2, "0001", "b", 50.0), (3, "0001", "a", 50.0),
                           (4, "0001", "c", 50.0)])
    r = area_vehicles_running(t).orderBy("action_time").collect()
    assert [(x.is_new, x.running_count) for x in r] == [(True, 1), (True, 2), (False, 2), (True, 3)]


def test_bitmap_materialized_equals_offsets(spark):
    t = traffic_df(spark, [(i * 997, "0001", f"car{i % 13}", 50.0) for i in range(300)])
    a = {(x.start_time, x.car_count) for x in area_vehicles_bitmap(t).collect()}
    b = {(x.start_time, x.car_count) for x in area_vehicles_bitmap(t, materialize=True).collect()}
    assert a == b


def test_running_distinct_matches_brute_force(spark):
    import random
    rnd = random.Random(11)
    rows = [(rnd.randrange(0, 90_000), "0001", f"car{rnd.randrange(6)}", 50.0, i) for i in range(300)]
    got = {(x.seq, x.is_new, x.running_count)
           for x in area_vehicles_running(traffic_df(spark, rows), 30_000, bucket_ms=700).collect()}
    want, seen = set(), {}
    for t, _, car, _, seq in sorted(rows, key=lambda r: (r[0], r[4])):
        w = t - t % 30_000
        cars = seen.setdefault(w, set())
        new = car not in cars
        cars.add(car)
        want.add((seq, new, len(cars)))
    assert got == want


def test_flow_tumbling_and_detected_at(spark):
    from roadsight.functions.exprs import with_detected_at
    from roadsight.operators.flow import flow
    t = traffic_df(spark, [(1, "0001", "a", 50.0), (29_999, "0001", "b", 50.0), (30_000, "0001", "c", 50.0),
                           (5, "0002", "d", 50.0)])
    got = sorted((r.start_time, r.end_time, r.monitor_id, r.car_count)
                 for r in flow(t, "30 seconds", None).collect())
    assert got == [(0, 30_000, "0001", 2), (0, 30_000, "0002", 1), (30_000, 60_000, "0001", 1)]
    stamped = with_detected_at(flow(t, "30 seconds", None))
    assert "detected_at" in stamped.columns and stamped.filter("detected_at IS NULL").count() == 0


def test_avg_speed_of_missing_speeds_and_many_decimals(spark):
    from roadsight.operators.flow import avg_speed
    df = spark.createDataFrame([(1_000, "0001", 10.004), (2_000, "0001", 10.004), (3_000, "0001", 10.014),
                                (4_000, "0002", 50.0), (5_000, "0002", None), (6_000, "0003", None)],
                               "action_time long, monitor_id string, speed double")
    got = {r.monitor_id: (r.avg_speed, r.car_count) for r in avg_speed(df, "1 minute", "1 minute").collect()}
    assert got == {"0001": (10.01, 3), "0002": (50.0, 2), "0003": (None, 1)}
