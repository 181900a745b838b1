import tempfile

from conftest import traffic_df

from roadsight.sinks import read_tracks, upsert_daily_violations, write_jdbc, write_tracks
from roadsight.operators.watchlist import to_track

DERBY = "jdbc:derby:memory:roadsight_test;create=true"
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_jdbc_append_and_read(spark):
    df = spark.createDataFrame([("a", "0001", "001", 70.0, 60, 1)],
                               "car string, monitor_id string, road_id string, real_speed double, "
                               "limit_speed int, action_time long")
    write_jdbc(df, DERBY, "t_speeding_info", driver=DRIVER)
    write_jdbc(df, DERBY, "t_speeding_info", driver=DRIVER)
    back = spark.read.format("jdbc").option("url", DERBY).option("dbtable", "t_speeding_info") \
        .option("driver", DRIVER).load()
    assert back.count() == 2 and back.filter("limit_speed > 0").count() == 2


def test_daily_upsert_table(spark):
    path = tempfile.mkdtemp(prefix="roadsight-upsert-") + "/t"
    mk = lambda rows: spark.createDataFrame(rows, "car string, violation string, create_time long, out_count int")
    upsert_daily_violations(mk([("a", "m1", 1_000, 3), ("b", "n1", 86_400_001, 1)]), path)
    t = upsert_daily_violations(mk([("a", "m2", 2_000, 4)]), path)
    got = sorted((x.car, str(x.day), x.violation, x.out_count) for x in t.collect())
    assert got == [("a", "1970-01-01", "m1", 4), ("b", "1970-01-02", "n1", 1)]


def test_track_table_last_write_wins(spark):
    path = tempfile.mkdtemp(prefix="roadsight-tracks-") + "/t"
    write_tracks(to_track(traffic_df(spark, [(5, "0001", "a", 50.0), (6, "0001", "b", 50.0)])), path)
    write_tracks(to_track(traffic_df(spark, [(5, "0009", "a", 55.0)])), path)
    cur = {x.row_key: x.monitor_id for x in read_tracks(spark, path).collect()}
    assert len(cur) == 2 and [v for k, v in cur.items() if k.startswith("a_")] == ["0009"]
    assert read_tracks(spark, path, car="b").count() == 1


def test_jdbc_dimensions_with_pushdown(spark):
    from roadsight.sources.dims import read_monitor_limits, read_violation_list
    url = "jdbc:derby:memory:roadsight_dims;create=true"
    lim = spark.createDataFrame([("0000", "02", 60, "01"), ("0001", "02", 60, "02"), ("0002", "03", 80, "01"),
                                 ("0004", "05", 100, "03"), ("0005", "04", 0, None), ("0021", "04", 0, None)],
                                "monitor_id string, road_id string, speed_limit int, area_id string")
    write_jdbc(lim, url, "t_monitor_info", driver=DRIVER)
    got = read_monitor_limits(spark, jdbc={"url": url, "driver": DRIVER})
    assert sorted(r.monitor_id for r in got.collect()) == ["0000", "0001", "0002", "0004"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(speed_limit,0)" in plan.replace(" ", "")
    vl = spark.createDataFrame([("京P88888", "违章未处理超过89次", None), ("京P66666", "嫌疑套牌车", None)],
                               "car string, violation string, create_time long")
    write_jdbc(vl, url, "t_violation_list", driver=DRIVER)
    rows = read_violation_list(spark, jdbc={"url": url, "driver": DRIVER}).collect()
    assert {(r.car, r.create_time, r.out_count) for r in rows} == {("京P88888", None, 0), ("京P66666", None, 0)}


def test_daily_upsert_keeps_undated_reports(spark):
    path = tempfile.mkdtemp(prefix="roadsight-upsert-") + "/t"
    mk = lambda rows: spark.createDataFrame(rows, "car string, violation string, create_time long, out_count int")
    upsert_daily_violations(mk([("a", "m1", None, 3), ("b", "n1", 1_000, 1)]), path)
    t = upsert_daily_violations(mk([("c", "m2", None, 4)]), path)
    assert sorted((x.car, x.out_count) for x in t.collect()) == [("a", 3), ("b", 1), ("c", 4)]


def test_daily_upsert_raises_when_the_table_cannot_be_read(spark):
    import os
    import pytest
    path = tempfile.mkdtemp(prefix="roadsight-upsert-") + "/t"
    mk = lambda rows: spark.createDataFrame(rows, "car string, violation string, create_time long, out_count int")
    upsert_daily_violations(mk([("a", "m1", 1_000, 3)]), path)
    day = path + "/day=1970-01-01"
    for name in os.listdir(day):
        if name.startswith("part-"):
            with open(f"{day}/{name}", "wb") as f:
                f.write(b"no parquet")
        elif name.endswith(".crc"):
            with open(f"{day}/{name}", "wb") as f:
                f.write(b"")
    with pytest.raises(Exception):
        upsert_daily_violations(mk([("b", "m2", 2_000, 4)]), path)
