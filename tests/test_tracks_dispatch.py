from conftest import traffic_df

from roadsight.functions.exprs import track_row_key
from roadsight.operators.danger import daily_violation_upsert
from roadsight.operators.dispatch import classify_violation_action, violation_action_interval
from roadsight.operators.watchlist import (
    latest_tracks, listed_passes, track_batches, track_listed_cars, violation_king, to_track,
)
from roadsight.plans.numbering import count_window


def watch(spark, rows):
    return spark.createDataFrame(rows, "car string, violation string, create_time long, out_count int")


def test_row_key(spark):
    df = spark.createDataFrame([("京P88888", 1592515403000)], "car string, action_time long")
    assert df.select(track_row_key().alias("k")).first().k == "京P88888_9223370444339372807"


def test_semi_join_no_duplicates_and_last_write_wins(spark):
    t = traffic_df(spark, [(5, "0001", "a", 50.0), (5, "0002", "a", 60.0), (6, "0001", "b", 50.0)])
    w = watch(spark, [("a", "x", None, 0), ("a", "y", None, 0)])
    assert listed_passes(t, w).count() == 2
    keyed = track_listed_cars(t, w).collect()
    assert len(keyed) == 1 and keyed[0].monitor_id == "0002"


def test_violation_king(spark):
    w = watch(spark, [("a", "违章未处理超过50次", None, 0), ("b", "违章未处理超过51次", None, 0),
                      ("c", "嫌疑套牌车", None, 0)])
    assert [x.car for x in violation_king(w).collect()] == ["b"]


def test_latest_tracks(spark):
    t = traffic_df(spark, [(i, "0001", "a", 50.0) for i in range(10)])
    assert [x.action_time for x in latest_tracks(t, 3).orderBy("rank").collect()] == [9, 8, 7]


def test_count_window(spark):
    df = spark.range(45).withColumnRenamed("id", "t")
    full = count_window(df, 20, ["t"]).collect()
    assert sorted({x.batch_id for x in full}) == [0, 1] and len(full) == 40
    part = count_window(df, 20, ["t"], emit_partial=True).collect()
    assert len(part) == 45 and {x.t for x in part if x.batch_id == 2} == set(range(40, 45))
    assert all(x.batch_id == x.t // 20 for x in part)


def test_track_batches(spark):
    t = to_track(traffic_df(spark, [(i, "0001", "a", 50.0) for i in range(45)]))
    assert track_batches(t, 20).count() == 40


def dispatch_input(spark, vts, pts):
    v = spark.createDataFrame([("c", "x", t, 0, i) for i, t in enumerate(vts)],
                              "car string, violation string, create_time long, out_count int, seq long")
    p = spark.createDataFrame([(f"J{i}", "c", "done", t, 100 + i) for i, t in enumerate(pts)],
                              "police_id string, car string, action_status string, action_time long, seq long")
    return v, p


def test_interval_bounds_inclusive(spark):
    v, p = dispatch_input(spark, [0], [-1, 0, 10_000, 10_001])
    assert sorted(x.action_time for x in violation_action_interval(v, p).collect()) == [0, 10_000]
    v, p = dispatch_input(spark, [100_000], [100_001, 100_002])
    assert violation_action_interval(v, p).count() == 2


def test_full_classification(spark):
    v, p = dispatch_input(spark, [0, 50_000], [5_000, 90_000])
    got = sorted((x.outcome, x.create_time, x.action_time) for x in classify_violation_action(v, p).collect())
    assert got == [("action_only", None, 90_000), ("matched", 0, 5_000), ("violation_only", 50_000, None)]


def test_daily_upsert(spark):
    day = 86_400_000
    new = watch(spark, [("a", "m2", 2_000, 4), ("a", "m3", day + 1, 3)])
    old = watch(spark, [("a", "m1", 1_000, 3)])
    got = sorted((str(x.day), x.violation, x.out_count) for x in daily_violation_upsert(new, old).collect())
    assert got == [("1970-01-01", "m1", 4), ("1970-01-02", "m3", 3)]
