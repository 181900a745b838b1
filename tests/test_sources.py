import pytest
from pyspark.sql import functions as F

from roadsight.sources import latest_by_key, parse_police_action, parse_traffic, parse_violation
from roadsight.sources.dims import area_names, valid_limits


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_parse_ignores_extra_fields(spark):
    r = parse_traffic(lines(spark, "1,0001,00001,京A00001,50.0,001,01,extra")).collect()
    assert r[0].asDict() == dict(action_time=1, monitor_id="0001", camera_id="00001", car="京A00001",
                                 speed=50.0, road_id="001", area_id="01")


@pytest.mark.parametrize("bad", ["1,0001", "x,0001,00001,c,50.0,001,01"])
def test_parse_strict_fails(spark, bad):
    with pytest.raises(Exception):
        parse_traffic(lines(spark, bad), mode="strict").collect()


def test_parse_permissive_keeps_corrupt_text(spark):
    r = parse_traffic(lines(spark, "x,0001,00001,c,50.0,001,01", "1,0001"), mode="permissive").collect()
    by = {x._corrupt_record: x for x in r}
    assert by["x,0001,00001,c,50.0,001,01"].action_time is None
    assert by["1,0001"].action_time == 1 and by["1,0001"].speed is None
    assert {x._corrupt_record for x in r} == {"x,0001,00001,c,50.0,001,01", "1,0001"}


def test_parse_violation_and_action(spark):
    v = parse_violation(lines(spark, "鲁H37985,涉嫌套牌车,1592515403000")).collect()[0]
    assert (v.car, v.violation, v.create_time, v.out_count) == ("鲁H37985", "涉嫌套牌车", 1592515403000, 0)
    p = parse_police_action(lines(spark, "J0002,鲁H37985,处理完成,1592515404000")).collect()[0]
    assert (p.police_id, p.car, p.action_status, p.action_time) == ("J0002", "鲁H37985", "处理完成",
                                                                    1592515404000)


def test_latest_by_key_last_load_wins(spark):
    df = spark.createDataFrame([("0001", 60, 1), ("0001", 80, 2), ("0002", 40, 1)],
                               "monitor_id string, speed_limit int, load_seq int")
    r = {x.monitor_id: x.speed_limit for x in latest_by_key(df, "monitor_id", "load_seq").collect()}
    assert r == {"0001": 80, "0002": 40}


def test_valid_limits_drops_zero(spark):
    df = spark.createDataFrame([("0000", "02", 60, "01"), ("0005", "04", 0, None)],
                               "monitor_id string, road_id string, speed_limit int, area_id string")
    assert [x.monitor_id for x in valid_limits(df).collect()] == ["0000"]


def test_area_names(spark):
    a = area_names(spark)
    assert a.count() == 8 and a.filter(F.col("area_id") == "01").first().area_name == "海淀区"


@pytest.mark.parametrize("bad", ["1,0001", "1,0001,00001,c,fast,001,01"])
@pytest.mark.parametrize("use", [lambda d: d.count(), lambda d: d.select("car").collect(),
                                 lambda d: d.groupBy("car").count().collect()])
def test_parse_strict_fails_when_columns_are_pruned(spark, bad, use):
    with pytest.raises(Exception):
        use(parse_traffic(lines(spark, "1,0001,00001,c,50.0,001,01", bad), mode="strict"))


def test_plates_are_padded_and_never_cut(spark):
    from roadsight.sources.testbed import _plate
    df = spark.createDataFrame([(7,), (12345,), (123456,)], "id long")
    assert [r[0][-n:] for r, n in zip(df.select(_plate("id")).collect(), (5, 5, 6))] == ["00007", "12345", "123456"]
