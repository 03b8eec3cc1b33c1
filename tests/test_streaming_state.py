"""Keyed streaming state for gaps and flatlines: runs continue across micro-batches, late rows go aside."""
import pandas as pd

from conftest import ts
from millwright.streaming.jobs import _monitor_fn


class FakeState:
    def __init__(self):
        self.value = None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v


def _batch(rows):
    return pd.DataFrame(rows, columns=["machine_id", "station_id", "line_id", "id", "timestamp", "vibration_rms"])


def _run(fn, state, rows):
    return next(fn(("M1", "S1"), iter([_batch(rows)]), state))


def test_run_continues_across_batches_and_late_rows_are_set_aside():
    fn = _monitor_fn(["vibration_rms"], gap_seconds=1800.0, min_run=6)
    st = FakeState()
    # batch 1: value 2.0 three times (two "same" flags), delivered out of order
    out1 = _run(fn, st, [("M1", "S1", "L", 3, ts(2), 2.0), ("M1", "S1", "L", 1, ts(0), 2.0),
                         ("M1", "S1", "L", 2, ts(1), 2.0)])
    assert out1.empty
    # batch 2: three more equal values -> the 6th equal reading (id 6) completes a run of 6
    out2 = _run(fn, st, [("M1", "S1", "L", 4, ts(3), 2.0), ("M1", "S1", "L", 5, ts(4), 2.0),
                         ("M1", "S1", "L", 6, ts(5), 2.0), ("M1", "S1", "L", 7, ts(60), 3.0)])
    stuck = out2[out2["kind"] == "stuck"]
    assert list(stuck["id"]) == [6]
    gaps = out2[out2["kind"] == "gap"]
    assert list(gaps["id"]) == [7] and gaps["value"].iloc[0] == 55 * 60.0
    # batch 3: a row older than the stored last reading is late and does not touch the state
    out3 = _run(fn, st, [("M1", "S1", "L", 8, ts(30), 3.0), ("M1", "S1", "L", 9, ts(61), 3.0)])
    assert list(out3[out3["kind"] == "late"]["id"]) == [8]
    assert out3[out3["kind"] == "gap"].empty


def test_one_call_monitors_many_machines_each_by_itself():
    """What a call for all machines tells is what calls for each of them tell."""
    rows = [(f"M{m}", "S1", "L", 100 * m + k, ts(7 * k + m), float(k // (m + 2))) for m in range(6) for k in range(30)]
    rows = [r for r in rows if r[3] % 100 not in (12, 13, 14, 15, 16)]
    halves = [[r for r in rows if r[4] < ts(150)], [r for r in rows if r[4] >= ts(150)] + [("M2", "S1", "L", 999, ts(1), 0.0)]]

    def told(groups):
        out = []
        for machines in groups:
            fn, st = _monitor_fn(["vibration_rms"], gap_seconds=1800.0, min_run=6), FakeState()
            for half in halves:
                got = next(fn((0,), iter([_batch([r for r in half if r[0] in machines])]), st))
                out += zip(got["machine_id"], got["kind"], got["id"], got["timestamp"], got["value"].fillna(-1))
        return sorted(out)
    each = [f"M{m}" for m in range(6)]
    got = told([each])
    assert got == told([[m] for m in each])
    assert {r[1] for r in got} == {"gap", "stuck", "late"} and len({r[0] for r in got}) == 6
