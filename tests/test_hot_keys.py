"""Keyed machines in buckets against sequential folds, on a plain stand-in for the state store."""

import random
from collections import defaultdict
from types import SimpleNamespace

import pytest
from conftest import traffic_df
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_keyed_state import fold_clone, fold_pairing

from roadsight.streaming import stateful as S


class State:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value if not isinstance(self.value, list) else iter(list(self.value))

    def update(self, value):
        self.value = tuple(value)

    def appendList(self, rows):
        self.value = (self.value or []) + list(rows)

    def put(self, rows):
        self.value = list(rows)

    def clear(self):
        self.value = [] if isinstance(self.value, list) else None


class ListOf(State):
    def __init__(self):
        self.value = []


class MapOf(State):
    def __init__(self):
        self.value = {}

    def keys(self):
        return iter(self.value)

    def updateValue(self, key, value):
        self.value[key] = value

    def clear(self):
        self.value = {}


class Keyed:
    """One processor over all its keys: state, timers and the most records that a key ever held."""

    def __init__(self, make):
        self.make, self.keys, self.most = make, {}, 0

    def batch(self, rows_by_key, watermark):
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        out = []
        for key, rows in rows_by_key.items():
            processor, states, timers = self._key(key)
            out += list(processor.handleInputRows(key, iter(rows), now))
            self.most = max([self.most] + [len(s.value) for s in states if isinstance(s, ListOf)])
        for key in list(self.keys):
            processor, _, timers = self._key(key)
            for due in sorted(t for t in timers if t <= watermark):
                timers.discard(due)
                out += list(processor.handleExpiredTimer(key, now, SimpleNamespace(getExpiryTimeInMs=lambda d=due: d)))
        return out

    def _key(self, key):
        if key not in self.keys:
            states, timers = [], set()

            def new(kind):
                states.append(kind())
                return states[-1]
            processor = self.make()
            processor.init(SimpleNamespace(
                registerTimer=timers.add, getListState=lambda *a: new(ListOf), getValueState=lambda *a: new(State),
                getMapState=lambda *a: new(MapOf)))
            self.keys[key] = (processor, states, timers)
        return self.keys[key]


def chained(rule, records, width, batches=7):
    """Run records ``(car, *record)``, dealt to batches by time, through both steps."""
    at = rule.record.fieldNames().index(rule.time) + 1
    records = sorted(records, key=lambda r: r[at])
    tie = T.LongType()
    first, second = Keyed(lambda: S.BucketTraces(rule, width, tie)), Keyed(lambda: S.ChainTraces(rule, width, tie))
    cut = [len(records) * i // batches for i in range(batches + 1)]
    out, watermark = [], 0
    for lo, hi in [*zip(cut[:-1], cut[1:]), (len(records), len(records))]:
        part, by = records[lo:hi], defaultdict(list)
        random.Random(lo).shuffle(part)
        for r in part:
            by[(r[0], r[at] // width)].append(dict(zip(rule.record.fieldNames(), r[1:])))
        lanes = defaultdict(list)
        for r in first.batch(by, watermark):
            lanes[(r.car, r.lane)].append(r.asDict())
        out += second.batch(lanes, watermark)
        watermark = records[hi - 1][at] if part else 10 ** 12
        if not part:
            for _ in range(2):
                lanes = defaultdict(list)
                for r in first.batch({}, watermark):
                    lanes[(r.car, r.lane)].append(r.asDict())
                out += second.batch(lanes, watermark)
    return out, first.most


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("width", [7_000, 60_000])
def test_bucketed_clone_machine_equals_the_fold(seed, width):
    rng = random.Random(seed)
    cars = ["hot"] * 4 + [f"c{i}" for i in range(8)]   # a car with a third of all rows
    step = rng.choice([300, 3_000, 20_000])
    rows = [(t * step + rng.randrange(step), f"m{rng.randrange(3)}", rng.choice(cars), 50.0, t) for t in range(600)]
    got, most = chained(S.CloneRule(), [(car, t, seq, m) for t, m, car, _, seq in rows], width)
    assert {(r.car, r.first_monitor, r.second_monitor, r.first_time, r.warning_time) for r in got} == fold_clone(rows)
    in_bucket = defaultdict(int)
    for t, _, car, _, _ in rows:
        in_bucket[(car, t // width)] += 1
    assert most <= max(in_bucket.values())


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("width", [4_000, 60_000])
def test_bucketed_pairing_machine_equals_the_fold(seed, width):
    rng = random.Random(seed)
    step = rng.choice([200, 2_000, 9_000])
    recs = [(rng.choice(["hot"] * 3 + ["a", "b", "c", "d", "e", "f"]), t * step + rng.randrange(step), t, rng.choice("vp")) for t in range(600)]
    got, _ = chained(S.PairRule(), [(car, t, seq, kind, f"v{seq}", f"p{seq}", "s") for car, t, seq, kind in recs], width)
    assert len(got) == len({tuple(r) for r in got})
    short = {(r.outcome, r.reason, r.car, r.create_time, r.action_time) if r.outcome == "matched" else
             (r.outcome, r.reason, r.car, r.create_time if r.create_time is not None else r.action_time) for r in got}
    want = {w if w[0] == "matched" else (w[0], w[1], w[2], [x for x in w[3:] if x is not None][0]) for w in fold_pairing(recs)}
    assert short == want


def grouped(rule, records, width, steps=5):
    """Run records ``(car, *record)`` as the streams do: buckets in Arrow batches, all cars in one key of the chain."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    tie, fields = T.LongType(), rule.record.fieldNames()
    at, schema = fields.index(rule.time) + 1, to_arrow_schema(S.part_schema(rule, tie))
    whole = T.StructType([T.StructField("cars", T.LongType()), T.StructField("car", T.StringType()),
                          T.StructField("bucket", T.LongType()), T.StructField("records", T.ArrayType(S.with_tie(rule.record, tie)))])
    buckets = defaultdict(list)
    for r in sorted(records, key=lambda r: (r[at], r[2])):
        buckets[(r[at] // width, r[0])].append(dict(zip(fields, r[1:])))
    last, first, chain, out = max(b for b, _ in buckets), S.BucketTraces(rule, width, tie), Keyed(lambda: S.ChainTraces(rule, width, tie)), []
    for step in range(steps + 1):
        lo, hi = ((last + 1) * i // steps for i in (step, step + 1))
        rows = [dict(cars=0, car=car, bucket=b, records=recs) for (b, car), recs in buckets.items() if lo <= b < hi]
        random.Random(step).shuffle(rows)
        batch = pa.RecordBatch.from_pylist([{}, *rows], schema=to_arrow_schema(whole)).slice(1)    # with an offset, as Arrow allows
        lanes = defaultdict(list)
        for part in next(first.of_batches([batch], schema)).to_pylist():
            lanes[(part["cars"], part["lane"])].append(part)
        out += chain.batch(lanes, hi * width if step < steps else 10 ** 12)
    return out, chain


def one_key_left_empty(machine):
    return [k for k in machine.keys if k[1] == -1] == [(0, -1)] and all(
        not s.value for _, states, _ in machine.keys.values() for s in states)


@pytest.mark.parametrize("seed", range(4))
def test_cars_that_share_a_key_of_the_clone_chain_equal_the_fold(spark, seed):
    rng = random.Random(seed)
    cars = ["hot"] * 100 + [f"c{i}" for i in range(200)]
    rows = [(t * 300 + rng.randrange(300), f"m{rng.randrange(3)}", rng.choice(cars), 50.0, t) for t in range(3_000)]
    got, chain = grouped(S.CloneRule(), [(car, t, seq, m) for t, m, car, _, seq in rows], 60_000)
    assert {(r.car, r.first_monitor, r.second_monitor, r.first_time, r.warning_time) for r in got} == fold_clone(rows)
    assert one_key_left_empty(chain)


@pytest.mark.parametrize("seed", range(4))
def test_cars_that_share_a_key_of_the_pairing_chain_equal_the_fold(spark, seed):
    rng = random.Random(seed)
    cars = ["hot"] * 100 + [f"c{i}" for i in range(200)]
    recs = [(rng.choice(cars), t * 200 + rng.randrange(200), t, rng.choice("vp")) for t in range(3_000)]
    got, chain = grouped(S.PairRule(), [(car, t, seq, kind, f"v{seq}", f"p{seq}", "s") for car, t, seq, kind in recs], 60_000)
    assert len(got) == len({tuple(r) for r in got})
    short = {(r.outcome, r.reason, r.car, r.create_time, r.action_time) if r.outcome == "matched" else
             (r.outcome, r.reason, r.car, r.create_time if r.create_time is not None else r.action_time) for r in got}
    want = {w if w[0] == "matched" else (w[0], w[1], w[2], [x for x in w[3:] if x is not None][0]) for w in fold_pairing(recs)}
    assert short == want and one_key_left_empty(chain)


def test_records_without_car_are_incomplete():
    got, _ = chained(S.PairRule(), [(None, 1_000, 1, "v", "x", None, None), (None, 1_500, 2, "p", None, "J", "s")], 60_000, 1)
    assert sorted((r.outcome, r.reason) for r in got) == [("unmatched_action", "incomplete"), ("unmatched_violation", "incomplete")]
    assert chained(S.CloneRule(), [(None, 1_000, 1, "m"), (None, 1_100, 2, "n")], 60_000, 1)[0] == []


@pytest.mark.parametrize("lower,upper", [(0, 10_000), (-5_000, 5_000), (2_000, 9_000), (-8_000, -1_000)])
def test_interval_outer_match_reports_each_record_once(lower, upper):
    rng = random.Random(upper)
    width, reach = 20_000, max(abs(lower), abs(upper))
    recs = sorted((rng.randrange(400_000), i, rng.choice("vp"), rng.choice(["hot", "hot", "a", "b", None])) for i in range(500))
    machine, out, watermark = Keyed(lambda: S.IntervalOuterProcessor(lower, upper)), [], 0
    for lo in range(0, 600, 100):
        by = defaultdict(list)
        for t, i, kind, car in recs[lo:lo + 100]:
            for b in range((t - reach) // width, (t + reach) // width + 1):
                by[(car, b)].append(dict(t=t, seq=0, kind=kind, violation=f"v{i}", police_id=f"p{i}", action_status="s",
                                         _own=b == t // width, _hit=False))
        out += machine.batch(by, watermark)
        watermark = recs[min(lo + 99, 499)][0] if lo < 500 else 10 ** 9
    out += machine.batch({}, 10 ** 9) + machine.batch({}, 2 * 10 ** 9)
    want = []
    for t, i, kind, car in recs:
        other = [r for r in recs if car is not None and r[3] == car and r[2] != kind
                 and lower <= ((r[0] - t) if kind == "v" else (t - r[0])) <= upper]
        if kind == "v":
            want += [("matched", car, f"v{i}", f"p{r[1]}") for r in other]
        if not other:
            want.append(("violation_only", car, f"v{i}", None) if kind == "v" else ("action_only", car, None, f"p{i}"))
    got = [(r.outcome, r.car, r.violation, r.police_id) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(not s.value for _, states, _ in machine.keys.values() for s in states)   # nothing stays


def test_dangerous_car_with_thousands_of_passes_in_two_minutes(spark):
    from roadsight.operators.danger import dangerous_car
    n = 5_000
    df = spark.range(n).select(F.lit("c").alias("car"), (1_799_000 + F.col("id") * 20).alias("action_time"), F.col("id").alias("seq"),
                               F.lit("m").alias("monitor_id"), (100.0 + F.col("id") % 7).alias("real_speed"), F.lit(60).alias("limit_speed"))
    got = dangerous_car(df, text=False)
    assert got.columns == ["car", "start_time", "end_time", "pass_count", "avg_speed"]
    rows = {r.end_time: r for r in got.collect()}
    assert len(rows) == n - 2
    last = rows[1_799_000 + 20 * (n - 1)]
    assert last.pass_count == n and last.start_time == 1_799_000 and abs(last.avg_speed - 103) < 0.01


def test_dangerous_car_by_another_condition(spark):
    from roadsight.operators.danger import dangerous_car
    t = traffic_df(spark, [(i * 1_000, f"m{i}", "a", 30.0 + i) for i in range(6)]).withColumnRenamed("speed", "real_speed").withColumn("limit_speed", F.lit(100))
    assert dangerous_car(t).count() == 0
    got = dangerous_car(t, condition=F.col("real_speed") >= 32).orderBy("end_time").collect()
    assert [(r.start_time, r.pass_count) for r in got] == [(2_000, 3), (2_000, 4)]


def test_bitmap_containers_follow_their_bits_and_merge(spark):
    from roadsight.operators.flow import area_vehicles_bitmap, bitmap_count, merge_bitmaps
    rows = [(i % 2 * 30_000 + 1, "m", f"car{i % 700 if i < 900 else i}", 1.0) for i in range(9_000)]
    t = traffic_df(spark, rows)
    built = area_vehicles_bitmap(t, "30 seconds", 1 << 16, materialize=True)    # two chunks, dense with so many cars
    plain = {r.start_time: r.car_count for r in area_vehicles_bitmap(t, "30 seconds", 1 << 16).collect()}
    got = built.collect()
    assert {r.start_time: r.car_count for r in got} == plain and len(got) == 2
    few = area_vehicles_bitmap(t.limit(50), "30 seconds", 1 << 16, materialize=True).collect()
    assert all(c.bits is None and len(c.offsets) <= 50 for r in few for c in r.bitmap)
    assert any(c.bits is not None for r in got for c in r.bitmap) or max(plain.values()) <= 4_096
    many = built.unionByName(area_vehicles_bitmap(t.limit(50), "30 seconds", 1 << 16, materialize=True))
    whole = merge_bitmaps(many, ["area_id"]).select(bitmap_count("bitmap").alias("n")).first().n
    from roadsight.functions.exprs import bitmap_offset
    assert whole == t.select(bitmap_offset("car", 1 << 16)).distinct().count()


def test_detection_stamp_is_added(spark):
    from roadsight.functions.exprs import with_detected_at
    out = with_detected_at(traffic_df(spark, [(1, "m", "c", 1.0)]))
    assert out.schema["detected_at"].dataType == T.TimestampType() and out.first().detected_at is not None


def test_no_job_runs_while_a_dimension_join_is_planned(spark, tmp_path):
    from roadsight.operators.speed import out_of_speed
    from roadsight.plans.joins import size_known
    spark.createDataFrame([("0002", 80)], "monitor_id string, speed_limit int").write.parquet(str(tmp_path / "limits"))
    limits = spark.read.parquet(str(tmp_path / "limits"))
    t = traffic_df(spark, [(1, "0002", "a", 96.0)])
    assert size_known(limits)
    spark.sparkContext.setJobGroup("plan-only", "planning")
    try:
        plan = out_of_speed(t, limits)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only") == []
        assert "rightHint" not in plan._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count() == 1
