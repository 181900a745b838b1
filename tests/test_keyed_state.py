"""Closed forms vs literal sequential folds (the keyed-state semantics)."""

import random
from collections import defaultdict

import pytest
from conftest import traffic_df

from roadsight.operators.clone import cloned_plate
from roadsight.operators.danger import dangerous_car
from roadsight.operators.dispatch import pair_violation_action

# --------------------------------------------------------------- folds


def fold_clone(rows, gap=10_000):
    by_car = defaultdict(list)
    for t, m, car, sp, seq in rows:
        by_car[car].append((t, seq, m))
    out = set()
    for car, rs in by_car.items():
        held = None
        for t, seq, m in sorted(rs):
            if held is None:
                held = (t, seq, m)
            elif t - held[0] < gap:
                out.add((car, held[2], m, held[0], t))
                held = None
            else:
                held = (t, seq, m)
    return out


def fold_pairing(recs, timeout=5_000):
    """recs: (car, t, seq, kind).  Our rules: superseded pending = unmatched."""
    by_car = defaultdict(list)
    for car, t, seq, kind in recs:
        by_car[car].append((t, seq, kind))
    out = set()
    for car, rs in by_car.items():
        pend = None
        for t, seq, kind in sorted(rs):
            if pend is None:
                pend = (t, seq, kind)
            elif kind != pend[2] and t - pend[0] <= timeout:
                v, p = (pend, (t, seq, kind)) if pend[2] == "v" else ((t, seq, kind), pend)
                out.add(("matched", None, car, v[0], p[0]))
                pend = None
            else:
                reason = "superseded" if kind == pend[2] and t - pend[0] <= timeout else "expired"
                out.add(_lone(car, pend, reason))
                pend = (t, seq, kind)
        if pend is not None:
            out.add(_lone(car, pend, "expired"))
    return out


def _lone(car, rec, reason):
    t, _, kind = rec
    if kind == "v":
        return ("unmatched_violation", reason, car, t, None)
    return ("unmatched_action", reason, car, None, t)


def brute_danger(rows, times=3, within=120_000, emit="all"):
    by_car = defaultdict(list)
    for t, car, seq in rows:
        by_car[car].append((t, seq))
    out = set()
    for car, rs in by_car.items():
        rs.sort()
        for j in range(len(rs)):
            starts = [i for i in range(0, j - times + 2) if rs[j][0] - rs[i][0] < within]
            if emit == "longest":
                starts = starts[:1]
            for i in starts:
                out.add((car, rs[i][0], rs[j][0], j - i + 1))
    return out

# --------------------------------------------------------------- edge rows


def clone_rows(spark, times, monitors=None, **kw):
    monitors = monitors or [f"{i:04d}" for i in range(len(times))]
    t = traffic_df(spark, [(x, m, "car1", 50.0) for x, m in zip(times, monitors)])
    return sorted((r.first_time, r.warning_time) for r in cloned_plate(t, **kw).collect())


@pytest.mark.parametrize("times,expected", [
    ([0, 9_999], [(0, 9_999)]),
    ([0, 10_000], []),
    ([0, 5_000, 10_000, 15_000], [(0, 5_000), (10_000, 15_000)]),
    ([0, 5_000, 8_000, 60_000, 62_000], [(0, 5_000), (60_000, 62_000)]),
])
def test_clone_edges(spark, times, expected):
    assert clone_rows(spark, times) == expected


def test_clone_same_checkpoint(spark):
    assert clone_rows(spark, [0, 1_000], ["0001", "0001"]) == [(0, 1_000)]
    assert clone_rows(spark, [0, 1_000], ["0001", "0001"], distinct_monitors=True) == []


def danger_input(spark, times, speeds=None):
    speeds = speeds or [100.0] * len(times)
    rows = [(f"c", "0001", "001", s, 80, t, i) for i, (t, s) in enumerate(zip(times, speeds))]
    return spark.createDataFrame(rows, "car string, monitor_id string, road_id string, real_speed double, "
                                       "limit_speed int, action_time long, seq long")


@pytest.mark.parametrize("times,emit,expected", [
    ([0, 60_000, 119_999], "all", [3]),
    ([0, 60_000, 120_000], "all", []),
    ([0, 30_000, 60_000, 90_000], "all", [3, 3, 4]),
    ([0, 30_000, 60_000, 90_000], "longest", [3, 4]),
])
def test_danger_edges(spark, times, emit, expected):
    r = dangerous_car(danger_input(spark, times), emit=emit).collect()
    assert sorted(x.pass_count for x in r) == expected


def test_danger_skips_slow_pass(spark):
    r = dangerous_car(danger_input(spark, [0, 10_000, 20_000, 30_000], [100.0, 50.0, 100.0, 100.0]),
                      emit="longest").collect()
    assert [(x.pass_count, x.start_time, x.end_time) for x in r] == [(3, 0, 30_000)]


def test_danger_text_and_avg(spark):
    r = dangerous_car(danger_input(spark, [0, 1, 2], [100.0, 100.01, 100.0]), emit="longest").first()
    assert r.avg_speed == 100.0  # 300.01 / 3 = 100.0033
    assert r.violation.startswith("当前车辆c，涉嫌危险驾驶，它在两分钟内经过的卡口数为：3第1个卡口0001，车速为：100.0")
    assert r.violation.endswith("它在两分钟内的平均车速为：100.0")


def pair_input(spark, recs):
    v = [(car, "x", t, 0, seq) for car, t, seq, k in recs if k == "v"]
    p = [(f"J{seq}", car, "done", t, seq) for car, t, seq, k in recs if k == "p"]
    vdf = spark.createDataFrame(v, "car string, violation string, create_time long, out_count int, seq long")
    pdf = spark.createDataFrame(p, "police_id string, car string, action_status string, action_time long, seq long")
    return vdf, pdf


def run_pairing(spark, recs, **kw):
    v, p = pair_input(spark, recs)
    return {(r.outcome, r.reason, r.car, r.create_time, r.action_time)
            for r in pair_violation_action(v, p, **kw).collect()}


def test_pairing_edges(spark):
    assert run_pairing(spark, [("a", 0, 1, "v"), ("a", 5_000, 2, "p")]) == {("matched", None, "a", 0, 5_000)}
    assert run_pairing(spark, [("a", 0, 1, "v"), ("a", 5_001, 2, "p")]) == {
        ("unmatched_violation", "expired", "a", 0, None), ("unmatched_action", "expired", "a", None, 5_001)}
    assert run_pairing(spark, [("a", 0, 1, "p"), ("a", 3_000, 2, "v")]) == {("matched", None, "a", 3_000, 0)}
    assert run_pairing(spark, [("a", 0, 1, "v"), ("a", 1_000, 2, "v"), ("a", 2_000, 3, "p")]) == {
        ("unmatched_violation", "superseded", "a", 0, None), ("matched", None, "a", 1_000, 2_000)}
    assert run_pairing(spark, [("a", 0, 1, "v"), ("a", 1_000, 2, "p"), ("a", 2_000, 3, "v")]) == {
        ("matched", None, "a", 0, 1_000), ("unmatched_violation", "expired", "a", 2_000, None)}

# --------------------------------------------------------------- random folds


@pytest.mark.parametrize("seed,bucket_ms", [(1, 3_000), (2, 50_000), (3, 10 ** 9)])
def test_clone_matches_fold(spark, seed, bucket_ms):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(0, 300_000), f"{rnd.randrange(5):04d}", f"car{rnd.randrange(4)}", 50.0, i)
            for i in range(600)]
    got = {(r.car, r.first_monitor, r.second_monitor, r.first_time, r.warning_time)
           for r in cloned_plate(traffic_df(spark, rows), bucket_ms=bucket_ms).collect()}
    assert got == fold_clone(rows)


@pytest.mark.parametrize("seed,bucket_ms", [(4, 2_000), (5, 30_000), (6, 10 ** 9)])
def test_pairing_matches_fold(spark, seed, bucket_ms):
    rnd = random.Random(seed)
    recs = [(f"car{rnd.randrange(3)}", rnd.randrange(0, 200_000), i, rnd.choice("vp")) for i in range(500)]
    assert run_pairing(spark, recs, bucket_ms=bucket_ms) == fold_pairing(recs)


@pytest.mark.parametrize("seed,emit", [(7, "all"), (8, "longest")])
def test_danger_matches_brute_force(spark, seed, emit):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(0, 900_000), f"car{rnd.randrange(3)}", i) for i in range(400)]
    df = danger_input(spark, [t for t, _, _ in rows])
    from pyspark.sql import functions as F
    cars = spark.createDataFrame([(i, c) for i, (_, c, _) in enumerate(rows)], "seq long, car2 string")
    df = df.join(cars, "seq").drop("car").withColumnRenamed("car2", "car")
    got = {(r.car, r.start_time, r.end_time, r.pass_count) for r in dangerous_car(df, emit=emit).collect()}
    assert got == brute_danger([(t, c, s) for t, c, s in rows], emit=emit)


def test_late_rows_matches_brute_force(spark):
    from roadsight.streaming.twins import late_rows
    rnd = random.Random(21)
    rows = [(i * 1_000 + rnd.randrange(-9_000, 9_000), "0001", "c", 50.0, i) for i in range(400)]
    got = {(r.seq, r.max_seen_time) for r in late_rows(traffic_df(spark, rows), bucket=37).collect()}
    want, mx = set(), None
    for t, _, _, _, seq in rows:
        if mx is not None and mx - 5_000 > t:
            want.add((seq, mx))
        mx = t if mx is None else max(mx, t)
    assert got == want and len(want) > 0


def test_hot_key_is_split_over_tasks(spark):
    from pyspark.sql import functions as F
    from roadsight.plans.sequence import ordered_scan
    rows = [(i * 3_000, "0001", "hot", 50.0, i) for i in range(2_000)]   # one car, 100 minutes
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        s = ordered_scan(traffic_df(spark, rows), ["car"], "action_time", "seq", bucket_ms=60_000)
        parts = s.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
        assert sorted(r._pos for r in s.collect()) == list(range(1, 2_001))
    finally:
        spark.conf.set(key, old)


def test_range_split_equals_fold_with_timestamp_pileup(spark):
    rnd = random.Random(31)
    # many rows on few timestamps: time buckets cannot split them, ranges can
    rows = [(rnd.choice([0, 4_000, 30_000]), f"{rnd.randrange(3):04d}", f"car{rnd.randrange(2)}", 50.0, i)
            for i in range(500)]
    got = {(r.car, r.first_monitor, r.second_monitor, r.first_time, r.warning_time)
           for r in cloned_plate(traffic_df(spark, rows), split="range").collect()}
    assert got == fold_clone(rows)
    recs = [(f"car{rnd.randrange(2)}", rnd.choice([0, 3_000, 20_000]), i, rnd.choice("vp")) for i in range(400)]
    assert run_pairing(spark, recs, split="range") == fold_pairing(recs)
