"""Operators on what the package's own sources give: lines, no arrival number."""

from conftest import SF_SMALL, traffic_df

from roadsight.operators.clone import cloned_plate
from roadsight.operators.danger import dangerous_car
from roadsight.operators.dispatch import (
    classify_violation_action, pair_violation_action, violation_action_interval,
)
from roadsight.operators.flow import area_vehicles_running
from roadsight.operators.speed import with_limit
from roadsight.operators.watchlist import keyed_tracks, latest_tracks, to_track, track_batches
from roadsight.session import scratch_dir
from roadsight.sources import (
    parse_traffic, read_police_actions, read_violations, stream_police_actions, stream_violations,
)
from roadsight.sources import testbed as tb
from roadsight.streaming.harness import not_sentinel, replay, run_to_table
from roadsight.streaming.twins import cloned_plate_stream, dangerous_car_stream


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def passes(spark):
    """Two equal passes, a tie at another checkpoint, a later pass, another car."""
    return parse_traffic(lines(spark, ["1000,0001,c1,a,90.0,r,01", "1000,0001,c1,a,90.0,r,01",
                                       "1000,0002,c2,a,95.0,r,01", "4000,0003,c3,a,99.0,r,01",
                                       "5000,0003,c3,b,10.0,r,01"]))


def test_keyed_operators_need_no_seq(spark):
    t = passes(spark)
    assert sorted((r.first_monitor, r.second_monitor) for r in cloned_plate(t).collect()) == [
        ("0001", "0001"), ("0002", "0003")]
    assert latest_tracks(t, 1).count() == 2
    assert keyed_tracks(to_track(t)).count() == 3
    assert track_batches(to_track(t), 2).count() == 4
    assert "seq" not in track_batches(to_track(t), 2).columns


def test_running_count_keeps_equal_passes_apart(spark):
    got = area_vehicles_running(passes(spark)).collect()
    assert len(got) == 5
    assert sorted((r.car, r.is_new) for r in got) == [("a", False)] * 3 + [("a", True), ("b", True)]
    assert max(r.running_count for r in got) == 2


def test_running_count_keeps_rows_without_key(spark):
    t = traffic_df(spark, [(1000, "0001", None, 5.0), (None, "0001", "a", 5.0), (2000, "0001", "b", 5.0)])
    got = {(r.car, r.is_new, r.running_count) for r in area_vehicles_running(t).collect()}
    assert got == {(None, False, 0), ("a", None, None), ("b", True, 1)}


def test_danger_with_equal_passes(spark):
    limits = spark.createDataFrame([("0001", 50), ("0002", 50), ("0003", 50)], "monitor_id string, speed_limit int")
    longest = dangerous_car(with_limit(passes(spark), limits), emit="longest").collect()
    assert sorted(r.pass_count for r in longest) == [3, 4]
    assert {r.start_time for r in longest} == {1000}
    every = dangerous_car(with_limit(passes(spark), limits), emit="all").collect()
    assert sorted(r.pass_count for r in every) == [3, 3, 4]


def test_dispatch_from_files(spark):
    v, p = scratch_dir(spark, "v"), scratch_dir(spark, "p")
    lines(spark, ["a,x,1000", "b,x,2000", "c,x,9000", "c,x,9000"]).write.text(v + "/t")
    lines(spark, ["J1,a,done,3000", "J2,d,done,4000"]).write.text(p + "/t")
    vs, ps = read_violations(spark, v + "/t"), read_police_actions(spark, p + "/t")
    assert [(r.car, r.police_id) for r in violation_action_interval(vs, ps).collect()] == [("a", "J1")]
    assert sorted((r.outcome, r.car) for r in classify_violation_action(vs, ps).collect()) == [
        ("action_only", "d"), ("matched", "a"), ("violation_only", "b"), ("violation_only", "c"),
        ("violation_only", "c")]
    assert sorted((r.outcome, r.reason or "", r.car) for r in pair_violation_action(vs, ps).collect()) == [
        ("matched", "", "a"), ("unmatched_action", "expired", "d"), ("unmatched_violation", "expired", "b"),
        ("unmatched_violation", "expired", "c"), ("unmatched_violation", "superseded", "c")]
    assert run_to_table(stream_violations(spark, path=v + "/t"), "v").count() == 4
    assert run_to_table(stream_police_actions(spark, path=p + "/t"), "p").count() == 2


def test_pairing_keeps_records_without_car_or_time(spark):
    v = spark.createDataFrame([("a", "x", None, 0), (None, "y", 5, 0)],
                              "car string, violation string, create_time long, out_count int")
    p = spark.createDataFrame([("J1", "a", "done", None)],
                              "police_id string, car string, action_status string, action_time long")
    got = pair_violation_action(v, p).collect()
    assert sorted((r.outcome, r.violation or "") for r in got) == [
        ("unmatched_action", ""), ("unmatched_violation", "x"), ("unmatched_violation", "y")]
    assert {r.reason for r in got} == {"incomplete"}


def test_stream_without_seq_equals_batch(spark):
    t = parse_traffic(tb.traffic_lines(spark, SF_SMALL))
    flush = dict(monitor_id="__flush__", camera_id="", car="__flush__", road_id="", area_id="", speed=1e9)
    for rule in (False, True):
        s = replay(t, "action_time", "lines-clone", slices=3, sentinel=flush)[1]
        got = not_sentinel(run_to_table(cloned_plate_stream(s, distinct_monitors=rule), "lines-clone"))
        assert sorted(map(str, got.collect())) == sorted(map(str, cloned_plate(t, distinct_monitors=rule).collect()))
    pw = with_limit(t, tb.limits(spark, SF_SMALL))
    s = replay(t, "action_time", "lines-danger", slices=3, sentinel=flush)[1]
    got = not_sentinel(run_to_table(dangerous_car_stream(with_limit(s, tb.limits(spark, SF_SMALL))), "lines-danger"))
    assert sorted(map(str, got.collect())) == sorted(map(str, dangerous_car(pw).collect()))
