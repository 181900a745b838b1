"""Keyed state machines on Structured Streaming (``transformWithState``).

Each processor buffers a car's records in a ``ListState`` until the event-time
watermark has passed them (one timer per key at the earliest buffered time
``+ 1``, re-armed after each drain), then drains them
in ``(time, seq)`` order through the same rule as the batch closed form, so a
stream gives the batch result whatever the arrival order within the allowed
disorder.  Records later than the watermark are dropped by Spark (as in the
source jobs, which have no allowed lateness).
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from pyspark import cloudpickle

from roadsight.operators.clone import CLONE_MESSAGE

CLONE_INPUT = T.StructType([T.StructField("action_time", T.LongType()),
                            T.StructField("seq", T.LongType()),
                            T.StructField("monitor_id", T.StringType())])
CLONE_OUTPUT = ("car string, first_monitor string, second_monitor string, first_time long, "
                "warning_time long, warning_msg string")

PAIR_INPUT = T.StructType([T.StructField("t", T.LongType()), T.StructField("seq", T.LongType()),
                           T.StructField("kind", T.StringType()),
                           T.StructField("violation", T.StringType()),
                           T.StructField("police_id", T.StringType()),
                           T.StructField("action_status", T.StringType())])
PAIR_OUTPUT = ("outcome string, reason string, car string, violation string, create_time long, "
               "police_id string, action_status string, action_time long")

DANGER_EVENT = T.StructType([T.StructField("action_time", T.LongType()),
                             T.StructField("seq", T.LongType()),
                             T.StructField("monitor_id", T.StringType()),
                             T.StructField("real_speed", T.DoubleType()),
                             T.StructField("limit_speed", T.IntegerType()),
                             T.StructField("micros", T.LongType())])
DANGER_INPUT = T.StructType(DANGER_EVENT.fields + [T.StructField("_own", T.BooleanType())])


def with_tie(schema: T.StructType, tie: T.DataType) -> T.StructType:
    """``schema`` with ``seq`` of the type that the source's ties are ordered by."""
    return T.StructType([T.StructField(f.name, tie if f.name == "seq" else f.dataType) for f in schema.fields])


def _names(columns: str) -> list[str]:
    """Column names of a plain ``name type, ...`` text (workers have no session to parse it)."""
    return [c.split()[0] for c in columns.split(",")]


def danger_output(tie: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("car", T.StringType()),
                         T.StructField("events", T.ArrayType(with_tie(DANGER_EVENT, tie)))])


class _Buffered(StatefulProcessor):
    """Buffer records until the watermark passes them, then drain in order."""

    schema: T.StructType
    ts_field: str

    def order_by(self, tie: T.DataType) -> "_Buffered":
        """Take ``seq`` of another type than a number."""
        self.schema = with_tie(self.schema, tie)
        return self

    def init(self, handle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buffer", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        names = self.schema.fieldNames()
        recs = [tuple(r[n] for n in names) for r in rows]
        if recs:
            self.buf.appendList(recs)
            # one wake-up per batch: when the watermark passes the earliest row
            i = names.index(self.ts_field)
            self.handle.registerTimer(min(r[i] for r in recs) + 1)
        return iter([])

    def _take_ready(self, watermark: int) -> list:
        # every state call is a round trip to the JVM: no separate exists()
        recs = list(self.buf.get())
        if not recs:
            return []
        i = self.schema.fieldNames().index(self.ts_field)
        ready = sorted((r for r in recs if r[i] < watermark), key=lambda r: (r[i], r[1]))
        if ready:
            rest = [tuple(r) for r in recs if r[i] >= watermark]
            self.buf.clear()
            if rest:
                self.buf.put(rest)
                self.handle.registerTimer(min(r[i] for r in rest) + 1)
        return ready

    def close(self) -> None:
        pass


class ClonedPlateProcessor(_Buffered):
    """Held pass + next pass within ``gap_ms`` → warning, state cleared.

    A held pass that the watermark has left ``gap_ms`` behind can pair with
    nothing any more and is forgotten, so state keeps no plate for good.
    """

    schema = CLONE_INPUT
    ts_field = "action_time"

    def __init__(self, gap_ms: int = 10_000, distinct_monitors: bool = False):
        self.gap_ms, self.distinct_monitors = gap_ms, distinct_monitors

    def init(self, handle) -> None:
        super().init(handle)
        self.held = handle.getValueState("held", self.schema)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        ready = self._take_ready(wm)
        held = before = self.held.get()
        for t, seq, monitor in ready:
            if held is None:
                held = (t, seq, monitor)
            elif t - held[0] < self.gap_ms and not (
                    self.distinct_monitors and monitor is not None and monitor == held[2]):
                yield Row(car=key[0], first_monitor=held[2], second_monitor=monitor,
                          first_time=held[0], warning_time=t, warning_msg=CLONE_MESSAGE)
                held = None
            else:
                held = (t, seq, monitor)
        if held is not None and wm - held[0] >= self.gap_ms:
            held = None
        if held is None:
            if before is not None:
                self.held.clear()
        else:
            self.handle.registerTimer(held[0] + self.gap_ms + 1)
            if ready:
                self.held.update(tuple(held))


class PairingProcessor(_Buffered):
    """One pending record per car; opposite kind within ``timeout_ms`` pairs."""

    schema = PAIR_INPUT
    ts_field = "t"

    def __init__(self, timeout_ms: int = 5_000):
        self.timeout_ms = timeout_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.pending = handle.getValueState("pending", self.schema)

    @staticmethod
    def _lone(car, rec, reason):
        t, _, kind, violation, police_id, status = rec
        is_v = kind == "v"
        return Row(outcome="unmatched_violation" if is_v else "unmatched_action", reason=reason,
                   car=car, violation=violation, create_time=t if is_v else None,
                   police_id=police_id, action_status=status, action_time=None if is_v else t)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        car = key[0]
        pend = self.pending.get()
        pend = tuple(pend) if pend is not None else None
        changed = False
        for rec in self._take_ready(wm):
            changed = True
            if pend is None:
                pend = tuple(rec)
            elif rec[2] != pend[2] and rec[0] - pend[0] <= self.timeout_ms:
                v, p = (pend, rec) if pend[2] == "v" else (rec, pend)
                yield Row(outcome="matched", reason=None, car=car, violation=v[3],
                          create_time=v[0], police_id=p[4], action_status=p[5], action_time=p[0])
                pend = None
            else:
                same = rec[2] == pend[2] and rec[0] - pend[0] <= self.timeout_ms
                yield self._lone(car, pend, "superseded" if same else "expired")
                pend = tuple(rec)
        if pend is not None and pend[0] + self.timeout_ms < wm:
            # nothing within the timeout can arrive any more
            yield self._lone(car, pend, "expired")
            pend, changed = None, True
        elif pend is not None:
            self.handle.registerTimer(pend[0] + self.timeout_ms + 1)
        if changed:
            if pend is None:
                self.pending.clear()
            else:
                self.pending.update(pend)


class DangerousCarProcessor(_Buffered):
    """Recent speeding passes within ``within_ms``; ``times`` or more → match.

    Keyed by (car, time bucket of at least ``within_ms``): every pass arrives
    as owner of its bucket, and passes near a bucket's end also as halo of
    the next bucket, so a match is complete within its owner's key and only
    owner passes emit — a hot car is spread over its buckets.
    """

    schema = DANGER_INPUT
    ts_field = "action_time"

    def __init__(self, times: int = 3, within_ms: int = 120_000):
        self.times, self.within_ms = times, within_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.recent = handle.getListState("recent", self.schema)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        ready = self._take_ready(wm)
        recent = [tuple(r) for r in self.recent.get()]
        if not ready and not recent:
            return
        names = DANGER_EVENT.fieldNames()
        for rec in ready:
            recent = [r for r in recent if r[0] > rec[0] - self.within_ms] + [tuple(rec)]
            if rec[-1] and len(recent) >= self.times:       # owner pass ends a match
                yield Row(car=key[0], events=[dict(zip(names, r)) for r in recent])
        # later records have t >= watermark: older passes can never match again
        recent = [r for r in recent if r[0] > wm - self.within_ms]
        self.recent.clear()
        if recent:
            self.recent.put(recent)
            # wake up when the newest pass has gone out of reach, so that state does not stay
            self.handle.registerTimer(recent[-1][0] + self.within_ms)


# --- a hot key's machine in buckets -------------------------------------------------------------
#
# Both machines above hold at most one record, and a record that follows either uses the held one
# up or takes its place.  So a run of records leaves one of two traces, whatever was held before it:
# its first record is held (trace 0), or its first record used up the held one (trace 1).  A bucket
# of a key is run both ways where it lies; only what the two traces differ in, and the record each
# leaves held, travels to the step that knows what was held before.


class CloneRule:
    """Held pass + next pass within ``gap_ms``: a warning, nothing held."""

    record, time = CLONE_INPUT, "action_time"
    result = CLONE_OUTPUT

    def __init__(self, gap_ms: int = 10_000, distinct_monitors: bool = False):
        self.gap_ms, self.distinct_monitors = gap_ms, distinct_monitors

    def uses(self, held, rec) -> bool:
        return rec[0] - held[0] < self.gap_ms and not (
            self.distinct_monitors and rec[2] is not None and rec[2] == held[2])

    def used(self, car, held, rec):
        return (car, held[2], rec[2], held[0], rec[0], CLONE_MESSAGE)

    def replaced(self, car, held, rec):
        return None

    def expired(self, car, held):
        return None

    def incomplete(self, rec):
        """A record without car."""
        return None

    def expires(self, held) -> int:
        """First time at which the held record can do nothing any more."""
        return held[0] + self.gap_ms


class PairRule:
    """Pending record + record of the other kind within ``timeout_ms``: a pair, nothing pending."""

    record, time = PAIR_INPUT, "t"
    result = PAIR_OUTPUT

    def __init__(self, timeout_ms: int = 5_000):
        self.timeout_ms = timeout_ms

    def uses(self, held, rec) -> bool:
        return rec[2] != held[2] and rec[0] - held[0] <= self.timeout_ms

    def used(self, car, held, rec):
        v, p = (held, rec) if held[2] == "v" else (rec, held)
        return ("matched", None, car, v[3], v[0], p[4], p[5], p[0])

    def replaced(self, car, held, rec):
        same = rec[2] == held[2] and rec[0] - held[0] <= self.timeout_ms
        return tuple(PairingProcessor._lone(car, held, "superseded" if same else "expired"))

    def expired(self, car, held):
        return tuple(PairingProcessor._lone(car, held, "expired"))

    def incomplete(self, rec):
        return tuple(PairingProcessor._lone(None, rec, "incomplete"))

    def expires(self, held) -> int:
        return held[0] + self.timeout_ms + 1


def trace(rule, car, held, records) -> tuple[list, list]:
    """What ``records`` put out after ``held``, as (records before it, row); and what is held after each."""
    out, states = [], []
    for i, rec in enumerate(records):
        if held is None:
            row, held = None, rec
        elif rule.uses(held, rec):
            row, held = rule.used(car, held, rec), None
        else:
            row, held = rule.replaced(car, held, rec), rec
        if row is not None:
            out.append((i, row))
        states.append(held)
    return out, states


def part_schema(rule, tie: T.DataType) -> T.StructType:
    """Rows from buckets to the chain: finished rows, or a bucket's first record with both traces."""
    row, record = T.StructType.fromDDL(rule.result), with_tie(rule.record, tie)
    both = T.StructType([T.StructField("rows", T.ArrayType(row)), T.StructField("held", record)])
    return T.StructType([
        T.StructField("cars", T.LongType()), T.StructField("car", T.StringType()), T.StructField("bucket", T.LongType()),
        T.StructField("lane", T.LongType()), T.StructField("row", row), T.StructField("first", record),
        T.StructField("traces", T.ArrayType(both))])


def _moment(ms: int):
    import datetime
    return datetime.datetime.fromtimestamp(ms / 1000, datetime.timezone.utc)


def _values(struct) -> tuple | None:
    """A nested struct's values: structs inside a row arrive as dictionaries."""
    return None if struct is None else tuple(struct.values() if isinstance(struct, dict) else struct)


class BucketTraces(StatefulProcessor):
    """A (car, bucket): all its records, both traces once the watermark has passed the bucket's end.

    From where both traces hold the same, rows are finished: they leave on a lane of their own
    (``lane`` = bucket), beside the chain (``lane`` -1).

    :meth:`of_batches` does this for buckets that an aggregation has gathered, many to a call; as a
    processor it gathers the records of a bucket itself, at a call and some state requests a bucket.
    """

    def __init__(self, rule, width_ms: int, tie: T.DataType):
        self.rule, self.width_ms, self.schema = rule, width_ms, with_tie(rule.record, tie)
        self.names, self.fields = _names(rule.result), self.schema.fieldNames()

    def init(self, handle) -> None:
        self.handle = handle
        self.buf = handle.getListState("records", self.schema)

    def parts(self, car, bucket: int, recs: list):
        """What a bucket's records, in order, hand on."""
        names, fields, rule = self.names, self.fields, self.rule
        if car is None:
            for row in filter(None, map(rule.incomplete, recs)):
                yield dict(car=None, bucket=bucket, lane=bucket, row=dict(zip(names, row)), first=None, traces=None)
            return
        out0, states0 = trace(rule, car, None, recs)
        out1, states1 = trace(rule, car, None, recs[1:])
        out1 = [(i + 1, row) for i, row in out1]
        states1 = [None] + states1
        same = next((i for i, (x, y) in enumerate(zip(states0, states1)) if x == y), len(recs))
        for i, row in out0:
            if i > same:
                yield dict(car=car, bucket=bucket, lane=bucket, row=dict(zip(names, row)), first=None, traces=None)
        traces = [{"rows": [dict(zip(names, row)) for i, row in out if i <= same],
                   "held": None if states[-1] is None else dict(zip(fields, states[-1]))}
                  for out, states in ((out0, states0), (out1, states1))]
        yield dict(car=car, bucket=bucket, lane=-1, row=None, first=dict(zip(fields, recs[0])), traces=traces)

    def of_batches(self, batches, schema):
        """Arrow batches of (cars, car, bucket, records in order) to parts of the Arrow ``schema``."""
        import pyarrow as pa
        for batch in batches:
            lists = batch.column("records")
            flat = list(zip(*[c.to_pylist() for c in lists.flatten().flatten()]))
            rows, at = [], 0
            for cars, car, bucket, n in zip(*[batch.column(c).to_pylist() for c in ("cars", "car", "bucket")],
                                            lists.value_lengths().to_pylist()):
                for part in self.parts(car, bucket, flat[at:at + n]):
                    part["cars"] = cars
                    rows.append(part)
                at += n
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def handleInputRows(self, key, rows, timerValues):
        recs = [tuple(r[n] for n in self.fields) for r in rows]
        if recs:
            self.buf.appendList(recs)
            self.handle.registerTimer((key[1] + 1) * self.width_ms + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        recs = sorted((tuple(r) for r in self.buf.get()), key=lambda r: (r[0], r[1]))
        if not recs:
            return
        self.buf.clear()
        now = _moment(timerValues.getCurrentWatermarkInMs())
        for part in self.parts(*key, recs):
            yield Row(event_time=now, **part)

    def close(self) -> None:
        pass


class ChainTraces(StatefulProcessor):
    """Some cars: each car's buckets in order, each by the trace that fits what is held; state is that one record a car.

    Buckets arrive whole and in order, as all that a step of the watermark closes come in one micro-batch.
    Every key costs some requests to the state store, so a key is a group of cars, not one.
    """

    def __init__(self, rule, width_ms: int, tie: T.DataType):
        self.rule, self.width_ms = rule, width_ms
        self.schema = T.StructType([T.StructField("car", T.StringType()), *with_tie(rule.record, tie).fields])
        self.names = _names(rule.result)

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.schema)

    def _closed(self, held) -> int:
        """Watermark at which every bucket is closed that may hold a record within the held one's reach."""
        return ((self.rule.expires(held) - 1) // self.width_ms + 1) * self.width_ms + 1

    def _keep(self, held: dict) -> None:
        if held:
            self.held.put([(car, *record) for car, record in held.items()])
            self.handle.registerTimer(min(map(self._closed, held.values())))
        else:
            self.held.clear()

    def handleInputRows(self, key, rows, timerValues):
        result = Row(*self.names)
        if key[1] >= 0:  # finished in their bucket
            for r in rows:
                yield result(*_values(r["row"]))
            return
        held = {r[0]: tuple(r[1:]) for r in self.held.get()}
        for r in sorted(rows, key=lambda r: r["bucket"]):
            car, first, uses, row = r["car"], _values(r["first"]), False, None
            before = held.pop(car, None)
            if before is not None:
                uses = self.rule.uses(before, first)
                row = self.rule.used(car, before, first) if uses else self.rule.replaced(car, before, first)
            if row is not None:
                yield result(*row)
            rows_of, left = _values(r["traces"][int(uses)])
            for row in rows_of:
                yield result(*_values(row))
            if left is not None:
                held[car] = _values(left)
        self._keep(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, left, any_gone = timerValues.getCurrentWatermarkInMs(), {}, False
        for car, *record in self.held.get():
            if self._closed(record) > now:
                left[car] = record
                continue
            any_gone = True
            row = self.rule.expired(car, tuple(record))
            if row is not None:
                yield Row(*self.names)(*row)
        if any_gone:
            self._keep(left)

    def close(self) -> None:
        pass


FULL_INPUT = T.StructType(PAIR_INPUT.fields + [T.StructField("_own", T.BooleanType()), T.StructField("_hit", T.BooleanType())])
FULL_OUTPUT = ("outcome string, car string, violation string, create_time long, "
               "police_id string, action_status string, action_time long")


class IntervalOuterProcessor(StatefulProcessor):
    """Full outer interval match of one (car, bucket), each record owned by one bucket.

    A bucket also holds copies of the records of its neighbours that its own can match, so every
    record is judged once, by its owner, on all it can match: an owned violation puts out its
    pairs, or itself alone; an owned action only itself where nothing matches.  A record is judged
    when the watermark has passed all times it can match, and kept while another may need it.
    """

    def __init__(self, lower_ms: int, upper_ms: int):
        self.lower, self.upper = lower_ms, upper_ms
        self.names = _names(FULL_OUTPUT)

    def init(self, handle) -> None:
        self.handle = handle
        self.buf = handle.getListState("records", FULL_INPUT)

    def _due(self, r) -> int:
        """Watermark beyond which the record's matches have all arrived (``_hit`` marks it as judged)."""
        return (r[0] + max(self.upper, 0) if r[2] == "v" else r[0] + max(-self.lower, 0)) + 1

    def _gone(self, r) -> int:
        """Watermark beyond which no record that could match it is unjudged."""
        span = self.upper - self.lower
        return r[0] + max(self.upper, 0) + span + 1 if r[2] == "v" else r[0] + max(-self.lower, 0) + span + 1

    def handleInputRows(self, key, rows, timerValues):
        names = FULL_INPUT.fieldNames()
        recs = [tuple(r[n] for n in names) for r in rows]
        if recs:
            self.buf.appendList(recs)
            self.handle.registerTimer(min(self._due(r) for r in recs))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm, car = timerValues.getCurrentWatermarkInMs(), key[0]
        recs = sorted((tuple(r) for r in self.buf.get()), key=lambda r: r[0])
        if not recs:
            return
        sides = {kind: [r for r in recs if r[2] == kind] for kind in ("v", "p")}
        times = {kind: [r[0] for r in side] for kind, side in sides.items()}
        result, left = Row(*self.names), []
        for r in recs:
            if r[6] and not r[7] and self._due(r) <= wm:
                is_v = r[2] == "v"
                lo, hi = (r[0] + self.lower, r[0] + self.upper) if is_v else (r[0] - self.upper, r[0] - self.lower)
                other = "p" if is_v else "v"
                found = [] if car is None else sides[other][bisect_left(times[other], lo):bisect_right(times[other], hi)]
                if is_v:
                    for p in found:
                        yield result("matched", car, r[3], r[0], p[4], p[5], p[0])
                    if not found:
                        yield result("violation_only", car, r[3], r[0], None, None, None)
                elif not found:
                    yield result("action_only", car, None, None, r[4], r[5], r[0])
                r = r[:7] + (True,)
            if self._gone(r) > wm:
                left.append(r)
        self.buf.clear()
        if left:
            self.buf.put(left)
            self.handle.registerTimer(min(self._gone(r) if r[7] or not r[6] else self._due(r) for r in left))

    def close(self) -> None:
        pass


class TopRows(StatefulProcessor):
    """The ``n`` fastest checkpoints of a window, or of one of its lanes; holds ``n`` rows while it reads.

    The averages of a window come in one micro-batch, when the watermark closes it, so nothing is
    kept between batches.
    """

    def __init__(self, n: int):
        self.n = n

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        import heapq
        now = _moment(timerValues.getCurrentWatermarkInMs())
        best = heapq.nsmallest(self.n, rows, key=lambda r: (-r["avg_speed"] if r["avg_speed"] is not None else float("inf"), r["monitor_id"]))
        for rank, r in enumerate(best, 1):
            yield Row(start_time=r["start_time"], end_time=r["end_time"], rank=rank, monitor_id=r["monitor_id"],
                      avg_speed=r["avg_speed"], car_count=r["car_count"], event_time=now)

    def close(self) -> None:
        pass


TOP_OUTPUT = ("start_time long, end_time long, rank int, monitor_id string, avg_speed double, car_count int, "
              "event_time timestamp")

RUNNING_INPUT = T.StructType([T.StructField("action_time", T.LongType()), T.StructField("seq", T.LongType()),
                              T.StructField("car", T.StringType())])


class RunningCountProcessor(_Buffered):
    """An (area, window): passes in event order, each with the distinct cars up to it.

    Keeps the cars of the window and the passes that the watermark has not reached; all of it goes
    when the window is over.
    """

    schema = RUNNING_INPUT
    ts_field = "action_time"

    def __init__(self, window_ms: int):
        self.window_ms = window_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.cars = handle.getMapState("cars", T.StructType([T.StructField("car", T.StringType())]),
                                       T.StructType([T.StructField("at", T.LongType())]))
        self.total = handle.getValueState("total", T.StructType([T.StructField("n", T.LongType())]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        area, start = key
        end = start + self.window_ms
        ready = self._take_ready(wm)
        held = self.total.get()
        n, new = (held[0] if held is not None else 0), set()
        known = {k[0] for k in self.cars.keys()} if held is not None else set()
        for t, seq, car in ready:
            is_new = car is not None and car not in known
            if is_new:
                n += 1
                known.add(car)
                new.add(car)
            yield Row(start_time=start, end_time=end, area_id=area, car=car, action_time=t, seq=seq,
                      is_new=is_new, running_count=n)
        if wm >= end:
            if held is not None:
                self.cars.clear()
                self.total.clear()
        elif ready:
            for car in new:
                self.cars.updateValue((car,), (n,))
            self.total.update((n,))
            self.handle.registerTimer(end + 1)


def running_output(tie: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("start_time", T.LongType()), T.StructField("end_time", T.LongType()),
        T.StructField("area_id", T.StringType()), T.StructField("car", T.StringType()),
        T.StructField("action_time", T.LongType()), T.StructField("seq", tie),
        T.StructField("is_new", T.BooleanType()), T.StructField("running_count", T.LongType())])


# Ship these processors to Python workers by value: executors then need no
# installed copy of this package (only pyspark itself).
cloudpickle.register_pickle_by_value(sys.modules[__name__])
