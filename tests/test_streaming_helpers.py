from conftest import traffic_df
from pyspark.sql import functions as F

from roadsight.operators.flow import area_vehicles
from roadsight.streaming.dimensions import RefreshingDimension


def test_refreshing_dimension_reloads_on_schedule(spark):
    source = [[("0001", 60), ("0002", 80)]]
    now = [0.0]

    def loader():
        return spark.createDataFrame(source[0], "monitor_id string, speed_limit int")

    dim = RefreshingDimension(loader, "monitor_id", refresh_seconds=100, clock=lambda: now[0])
    first = {r.monitor_id: r.speed_limit for r in dim.get().collect()}
    source[0] = [("0001", 70)]                      # 0002 deleted at the source
    now[0] = 50.0
    assert {r.monitor_id: r.speed_limit for r in dim.get().collect()} == first and dim.loads == 1
    now[0] = 150.0
    assert {r.monitor_id: r.speed_limit for r in dim.get().collect()} == {"0001": 70, "0002": 80}
    assert dim.loads == 2


def test_hll_sketches_merge(spark):
    t = traffic_df(spark, [(i * 10, "0001", f"car{i % 40}", 50.0) for i in range(400)]).drop("seq")
    t = t.withColumn("area_id", F.when(F.col("action_time") % 20 == 0, "01").otherwise("02"))
    sk = area_vehicles(t, "30 seconds", distinct="sketch")
    exact = {(r.start_time, r.area_id): r.car_count for r in area_vehicles(t, "30 seconds").collect()}
    got = {(r.start_time, r.area_id): r.car_count for r in sk.collect()}
    assert got.keys() == exact.keys()
    assert all(abs(got[k] - exact[k]) <= max(1, 0.05 * exact[k]) for k in exact)
    merged = sk.agg(F.hll_sketch_estimate(F.hll_union_agg("car_sketch")).alias("n")).first().n
    assert abs(merged - 40) <= 2


def test_streaming_sinks(spark):
    import tempfile
    from roadsight.operators.danger import daily_violation_upsert
    from roadsight.sinks import upsert_daily_violations_stream, write_jdbc_stream
    from roadsight.streaming.harness import replay
    day = 86_400_000
    rows = [("a", f"m{i}", i * day // 3, i % 5) for i in range(12)] + [("b", "x", 5, 2)]
    reports = spark.createDataFrame(rows, "car string, violation string, create_time long, out_count int")
    _, stream = replay(reports, "create_time", "sink-test", slices=3)
    base = tempfile.mkdtemp(prefix="roadsight-sinks-")
    q = upsert_daily_violations_stream(stream, base + "/table", base + "/ck1")
    q.processAllAvailable()
    q.stop()
    got = sorted((r.car, str(r.day), r.violation, r.out_count)
                 for r in spark.read.parquet(base + "/table").collect())
    want = sorted((r.car, str(r.day), r.violation, r.out_count)
                  for r in daily_violation_upsert(reports, reports.limit(0)).collect())
    assert got == want

    url = "jdbc:derby:memory:roadsight_stream;create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    _, stream2 = replay(reports, "create_time", "sink-test-2", slices=3)
    q = write_jdbc_stream(stream2, url, "t_violation_list", base + "/ck2",
                          columns=["car", "violation", "create_time"], driver=driver)
    q.processAllAvailable()
    q.stop()
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "t_violation_list") \
        .option("driver", driver).load()
    assert back.count() == len(rows)
