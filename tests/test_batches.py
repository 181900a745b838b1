"""Work that spans micro-batches: a batch that runs again repeats the first run."""

from conftest import traffic_df
from pyspark.sql import functions as F

from roadsight.streaming.batches import batch_folders, count_windows, split_late, stamp_arrivals
from roadsight.streaming.dimensions import VersionedDimension


def test_versions_survive_restarts_and_repeat(spark, tmp_path):
    source, now = [[("0001", 60), ("0002", 80)]], [0.0]

    def dimension(**kw):   # a new one stands for a restarted process
        return VersionedDimension(spark, str(tmp_path), lambda: spark.createDataFrame(source[0], "monitor_id string, speed_limit int"),
                                  "monitor_id", refresh_seconds=100, clock=lambda: now[0], **kw)

    rows = lambda df: {r.monitor_id: r.speed_limit for r in df.collect()}
    dim = dimension()
    assert rows(dim.for_batch(0)) == {"0001": 60, "0002": 80}
    source[0], now[0] = [("0001", 70)], 50.0               # 0002 is gone at the source
    assert rows(dim.for_batch(1)) == {"0001": 60, "0002": 80}
    now[0] = 150.0
    assert rows(dimension().for_batch(2)) == {"0001": 70, "0002": 80}
    source[0], now[0] = [("0003", 30)], 500.0
    assert rows(dimension().for_batch(2)) == {"0001": 70, "0002": 80}      # batch 2 again: its own version
    assert rows(dimension().for_batch(1)) == {"0001": 60, "0002": 80}
    assert rows(dimension(keep=1).for_batch(3)) == {"0001": 70, "0002": 80, "0003": 30}
    assert rows(dimension(keep=1).for_batch(4)) == {"0001": 70, "0002": 80, "0003": 30}


def test_a_version_without_a_batch_is_written_again(spark, tmp_path):
    spark.createDataFrame([("x", 1, 0)], "monitor_id string, speed_limit int, _load long").write.parquet(str(tmp_path / "loads/0"))
    dim = VersionedDimension(spark, str(tmp_path), lambda: spark.createDataFrame([("a", 5)], "monitor_id string, speed_limit int"), "monitor_id")
    assert [tuple(r) for r in dim.for_batch(0).collect()] == [("a", 5)]


def test_count_windows_over_batches(spark, tmp_path):
    root = str(tmp_path)
    body = count_windows(spark, root, 4, ["action_time", "seq"], batch_folders(f"{root}/data"))
    t = traffic_df(spark, [(i, "m", f"c{i}", 1.0) for i in range(23)])
    parts = [t.where(f"action_time >= {lo} AND action_time < {hi}") for lo, hi in ((0, 3), (3, 4), (4, 15), (15, 15), (15, 23))]

    def stored():
        return sorted((r.batch_id, r.action_time) for r in spark.read.parquet(f"{root}/data").collect())
    for i, part in enumerate(parts):
        body(part, i)
        if i in (2, 4):
            before = stored()
            body(part, i)                                   # the same batch again changes nothing
            assert stored() == before
    assert stored() == [(i // 4, i) for i in range(20)]     # the last three wait for a fourth


def test_arrival_stamps_repeat_and_never_run_back(spark, tmp_path):
    root, ticks = str(tmp_path), iter([100.0, 90.0, 130.0])
    t = traffic_df(spark, [(1, "m", "c", 1.0)])
    body = stamp_arrivals(spark, root, clock=lambda: next(ticks))
    for batch_id in (0, 1, 1, 2):
        body(t, batch_id)
    got = {r._batch_id: r.arrival_time for r in spark.read.parquet(f"{root}/data").collect()}
    assert got == {0: 100_000, 1: 100_000, 2: 130_000}


def test_late_rows_leave_aside(spark, tmp_path):
    root = str(tmp_path)
    body = split_late(spark, root, batch_folders(f"{root}/on"), batch_folders(f"{root}/late"), delay_ms=5_000)
    make = lambda times: traffic_df(spark, [(0, "m", f"c{i}", 1.0) for i in range(len(times))]).join(
        spark.createDataFrame([(i, t) for i, t in enumerate(times)], "seq long, t long"), "seq").drop("action_time").withColumnRenamed("t", "action_time")
    batches = [[], [10_000, 2_000], [4_999, 5_000, 5_001, None, 30_000], [25_000, 26_000], [24_000, 25_001]]
    for i, times in enumerate(batches):
        body(make(times), i)
    body(make(batches[2]), 2)
    read = lambda side: sorted((r.action_time for r in spark.read.parquet(f"{root}/{side}").where(F.col("car").isNotNull()).collect()), key=str)
    assert read("late") == sorted([4_999, 5_000, 25_000, 24_000], key=str)
    assert read("on") == sorted([10_000, 2_000, 5_001, None, 30_000, 26_000, 25_001], key=str)


def test_replayed_slices_have_equal_numbers_of_files(spark):
    import os

    from roadsight.streaming.harness import replay
    t = traffic_df(spark, [(i * i, "m", "c", 1.0) for i in range(300)]).repartition(3)
    path, _ = replay(t, "action_time", "slices", slices=4)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert len(files) % 4 == 0 and len(files) >= 4 and spark.read.parquet(path).count() == 300
