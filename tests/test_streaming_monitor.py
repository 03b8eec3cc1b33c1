"""Keyed state in event-time order: arrival order does not matter, silence is told by timers, state is forgotten."""
import random
from datetime import timezone

import pandas as pd

from conftest import ts
from millwright.session import scratch_path
from millwright.streaming import jobs as sj, monitor

SCHEMA = "machine_id string, station_id string, line_id string, id long, timestamp timestamp, vibration_rms double"


def _run(spark, batches, delay="2 hours", **options):
    land, sink, ck = (scratch_path(spark, n) for n in ("land", "sink", "ck"))
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(land)
    monitor.use_rocksdb(spark)
    stream = sj.read_table_stream(spark, land, spark.createDataFrame([], SCHEMA).schema, 1)
    rows = monitor.machine_monitor(stream, 1800.0, delay, ["vibration_rms"], **options)
    sj.run_available(rows.writeStream.format("parquet").option("path", sink), ck)
    return sorted((r.machine_id, r.kind, r.id, r.value) for r in spark.read.parquet(sink).collect())


def test_gaps_runs_and_silence_in_any_order_of_arrival(spark):
    """Eight equal readings, a gap, one more; another machine falls silent; a third one moves time on."""
    rows = [("M1", "S", "L", k, ts(k * 5), 2.0) for k in range(8)] + [("M1", "S", "L", 8, ts(100), 3.0)]
    rows += [("M2", "S", "L", 20 + k, ts(k * 5), float(k % 2)) for k in range(8)] + [("M2", "S", "L", 30, None, 1.0)]
    random.Random(2).shuffle(rows)
    beat = [[("beat", "S", "L", 99, ts(600), 0.0)], [("beat", "S", "L", 100, ts(601), 0.0)]]
    got = _run(spark, [rows[:6], rows[6:12], rows[12:], *beat])
    assert [r for r in got if r[0] == "M1"] == [
        ("M1", "gap", 8, 65 * 60.0), ("M1", "silent", 7, 1800.0), ("M1", "silent", 8, 1800.0),
        ("M1", "stuck", 5, 2.0), ("M1", "stuck", 6, 2.0), ("M1", "stuck", 7, 2.0)]
    assert [r for r in got if r[0] == "M2"] == [("M2", "silent", 27, 1800.0)]


def test_silence_is_told_once_and_a_forgotten_machine_starts_anew(spark):
    batches = [[("M1", "S", "L", 1, ts(0), 1.0)], [("beat", "S", "L", 50, ts(400), 0.0)], [("beat", "S", "L", 51, ts(401), 0.0)],
               [("M1", "S", "L", 2, ts(402), 1.0)], [("beat", "S", "L", 52, ts(2000), 0.0)], [("beat", "S", "L", 53, ts(2001), 0.0)],
               [("M1", "S", "L", 3, ts(2002), 1.0)], [("beat", "S", "L", 54, ts(2500), 0.0)], [("beat", "S", "L", 55, ts(2501), 0.0)]]
    got = [r for r in _run(spark, batches, delay="1 minute", forget_seconds=60_000.0) if r[0] == "M1"]
    # 402 minutes are remembered, 1,600 are not: no gap before the third reading
    assert got == [("M1", "gap", 2, 402 * 60.0), ("M1", "silent", 1, 1800.0), ("M1", "silent", 2, 1800.0), ("M1", "silent", 3, 1800.0)]


class _Store:
    """A key's state and timers, and how often they were called."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, name, schema):
        return _Value(self)

    def getMapState(self, name, key, value):
        return _Map(self)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class _Value:
    def __init__(self, store):
        self.store, self.row = store, None

    def exists(self):
        self.store.calls += 1
        return self.row is not None

    def get(self):
        self.store.calls += 1
        return self.row

    def update(self, row):
        self.store.calls += 1
        self.row = row

    def clear(self):
        self.store.calls += 1
        self.row = None


class _Map:
    def __init__(self, store):
        self.store, self.rows = store, {}

    def keys(self):
        self.store.calls += 1
        return iter(list(self.rows))

    def containsKey(self, key):
        self.store.calls += 1
        return key in self.rows

    def getValue(self, key):
        self.store.calls += 1
        return self.rows[key]

    def updateValue(self, key, value):
        self.store.calls += 1
        self.rows[key] = value

    def removeKey(self, key):
        self.store.calls += 1
        del self.rows[key]


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def _monitored(chunks, watermarks):
    """Rows (kind, id, value) and calls of one key: a chunk arrives before each watermark, then its timers run out."""
    handle, out = _Store(), []
    m = monitor.MachineMonitor(["vibration_rms"], 1800.0, 6, 1e-9, 3600, 1e9)
    m.init(handle)
    for rows, mark in zip(chunks, watermarks):
        at = _At(int(mark.replace(tzinfo=timezone.utc).timestamp() * 1000))
        pdf = pd.DataFrame(rows, columns=["machine_id", "station_id", "line_id", "id", "timestamp", "vibration_rms"])
        out += m.handleInputRows(("M1", "S"), iter([pdf] if rows else []), at)
        for timer in sorted(t for t in handle.timers if t <= at.ms):
            if timer in handle.timers:
                handle.timers.discard(timer)
                out += m.handleExpiredTimer(("M1", "S"), at, _At(timer))
    told = pd.concat(out) if out else pd.DataFrame(columns=["kind", "id", "value"])
    return sorted(zip(told["kind"], told["id"], told["value"])), handle.calls


def test_readings_far_apart_cost_few_calls_of_the_state():
    rows = [("M1", "S", "L", k, ts(k * 120), float(k)) for k in range(200)]
    got, calls = _monitored([rows, []], [ts(-1), ts(200 * 120)])
    assert [r for r in got if r[0] == "gap"] == [("gap", k, 7200.0) for k in range(1, 200)]
    assert [r[1] for r in got if r[0] == "silent"] == list(range(200))
    assert calls < 40


def test_a_machine_of_many_readings_is_taken_in_order_of_time_piece_by_piece(monkeypatch):
    monkeypatch.setattr(monitor, "ENTRY_ROWS", 20)
    monkeypatch.setattr(monitor, "TAKE_ROWS", 30)
    rows = [("M1", "S", "L", k, ts(k * 10 + 60 * (k > 350)), float(k // 8 % 2)) for k in range(500)]
    want = _monitored([rows, []], [ts(-1), ts(10_000)])[0]
    random.Random(1).shuffle(rows)
    cuts = [rows[:15], rows[15:200], rows[200:], []]
    got = _monitored(cuts, [ts(-4), ts(-3), ts(-2), ts(10_000)])[0]
    assert got == want and [r for r in got if r[0] == "gap"] == [("gap", 351, 4200.0)]
    assert len([r for r in got if r[0] == "stuck"]) == 62 * 3


def test_many_machines_cost_no_more_calls_and_frames_than_one(monkeypatch):
    """A group's machines are told apart, nulls too, however their readings arrive; a call of the state serves all of them."""
    monkeypatch.setattr(monitor, "ENTRY_ROWS", 300)
    rng, rows, want = random.Random(5), [], []
    names = [(f"M{i}", "S") for i in range(198)] + [(None, "S"), ("M1", None)]
    for i, (machine, station) in enumerate(names):
        for k in range(9):
            late = 40 if k == 8 and i % 2 else 0
            rows.append((machine, station, "L", 100 * i + k, ts(k * 5 + late, i), 2.0 if i % 4 == 3 else float(k % 2)))
        if i % 2:
            want += [("gap", 100 * i + 8, 2700.0), ("silent", 100 * i + 7, 1800.0)]
        want.append(("silent", 100 * i + 8, 1800.0))
        want += [("stuck", 100 * i + k, 2.0) for k in (5, 6, 7, 8) if i % 4 == 3]
    rng.shuffle(rows)
    handle, out = _Store(), []
    m = monitor.MachineMonitor(["vibration_rms"], 1800.0, 6, 1e-9, 3600, 1e9)
    m.init(handle)
    frames = [pd.DataFrame(rows[i:i + 600], columns=["machine_id", "station_id", "line_id", "id", "timestamp", "vibration_rms"]) for i in range(0, len(rows), 600)]
    for chunks, mark in ((frames, ts(20)), ([], ts(47)), ([], ts(5_000))):
        at = _At(int(mark.replace(tzinfo=timezone.utc).timestamp() * 1000))
        told = [*m.handleInputRows((3,), iter(chunks), at)]
        assert len(told) <= 2
        out += told
    told = pd.concat(out)
    assert sorted(zip(told["kind"], told["id"], told["value"])) == sorted(want)
    assert all((None if x is None or x != x else x, None if y is None or y != y else y) == names[i // 100]
               for x, y, i in zip(told["machine_id"], told["station_id"], told["id"]))
    assert handle.calls < 60
