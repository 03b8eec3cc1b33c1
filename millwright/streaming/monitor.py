"""Gaps, flatlines and silent machines from keyed state (ST-6), in event-time order.

``transformWithStateInPandas`` on hash groups of (machine, station).  Arriving readings wait
in state by time bucket, in pieces of the chunks that come, so no task holds a group's whole
micro-batch; once the watermark has passed them they are taken in order of
time.  State that lasts is, of each machine, the last reading and, for each watched column, its
value and run length.  An event-time timer wakes a group when the next waiting
reading's turn has come, when a machine's last reading is older than the allowed gap
(it has fallen silent, though nothing arrives any more), and when one may be forgotten.
A group is whole in every call, so all its machines are looked after by the same watermark.

Needs the RocksDB state store (``use_rocksdb``).
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import quality as q
from .jobs import MONITOR_GROUPS, MONITOR_OUTPUT, _run_lengths_by, _texts

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKET_SECONDS = 3600
#: Readings of an entry at most, and readings that are put in order at once, about.
ENTRY_ROWS = 1_000
TAKE_ROWS = 20_000
NO_ID = np.iinfo("i8").max
FORGET_SECONDS = 365 * 86_400.0


def use_rocksdb(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class _Held:
    """What lasts of a group: of each of its machines the last reading and the run of each watched column, and what waits.

    Machines are (machine, station) pairs in the order of ``names``; ``id`` and ``line_id`` are those of the last reading.
    """

    SCHEMA = "machines binary, first long, entries long, timer long"

    def __init__(self, columns: int, row=None):
        machines, self.first, self.entries, self.timer = row or (None, None, 0, None)
        self.names, self.us, self.id, self.line_id, self.silent, self.values, self.runs = (
            ([], np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, "O"), np.empty(0, "?"), np.empty((0, columns)), np.empty((0, columns), "i8"))
            if machines is None else pickle.loads(machines))
        self.place = {name: i for i, name in enumerate(self.names)}

    def find(self, names: list[tuple]) -> np.ndarray:
        """Places of machines that are held, else -1."""
        return np.fromiter((self.place.get(name, -1) for name in names), dtype="i8", count=len(names))

    def put(self, names: list[tuple], us, ids, lines, values, runs) -> None:
        """The machines' last readings: of those held already and, at the end, of new ones."""
        for name in names:
            if name not in self.place:
                self.place[name] = len(self.names)
                self.names.append(name)
        more = len(self.names) - len(self.us)
        if more:
            self.us, self.id, self.line_id, self.silent, self.values, self.runs = (
                np.concatenate([old, np.empty((more, *old.shape[1:]), dtype=old.dtype)])
                for old in (self.us, self.id, self.line_id, self.silent, self.values, self.runs))
        at = self.find(names)
        self.us[at], self.id[at], self.line_id[at], self.silent[at], self.values[at], self.runs[at] = us, ids, lines, False, values, runs

    def forget(self, gone: np.ndarray) -> None:
        self.names = [name for name, x in zip(self.names, gone) if not x]
        self.place = {name: i for i, name in enumerate(self.names)}
        self.us, self.id, self.line_id, self.silent, self.values, self.runs = (
            a[~gone] for a in (self.us, self.id, self.line_id, self.silent, self.values, self.runs))

    def row(self) -> tuple:
        machines = pickle.dumps((self.names, self.us, self.id, self.line_id, self.silent, self.values, self.runs), protocol=5)
        return machines, self.first, self.entries, self.timer


class MachineMonitor(StatefulProcessor):
    """Rows of ``MONITOR_OUTPUT``: ``gap``, ``stuck``, ``silent`` and ``late``.

    ``gap``: a reading more than ``gap_seconds`` after the one before (value: the gap).
    ``silent``: a reading after which none came for ``gap_seconds`` (value: those),
    known as soon as the watermark is that far.  ``late``: a reading older
    than one of its machine that has been taken already.

    A key is a group of machines: a call to the state store, a data frame and a call of
    this class cost more than the readings of most machines.  What lasts of a group is one value, waiting readings
    are entries of many machines, a group has one timer, and its rows leave in few frames.
    """

    def __init__(self, columns: list[str], gap_seconds: float, min_run: int, tolerance: float,
                 bucket_seconds: int, forget_seconds: float):
        self.columns, self.gap_us, self.gap_seconds = columns, round(gap_seconds * 1e6), gap_seconds
        self.need, self.tolerance = max(min_run - 1, 1), tolerance
        self.bucket_us, self.forget_us = bucket_seconds * 1_000_000, round(forget_seconds * 1e6)
        self.kind = [("machine", "O"), ("station", "O"), ("us", "i8"), ("id", "i8"), ("line_id", "O"), ("x", "f8", (len(columns),))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _Held.SCHEMA)
        self.waiting = handle.getMapState("waiting", "bucket long, entry long", "readings binary")

    # -- arrival ---------------------------------------------------------
    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = _Held(len(self.columns), self.held.get())
        for chunk in rows:
            part = self._readings(chunk)
            if held.names:
                at = held.find(_names(part))
                # of a machine that isn't held the last one's values are looked up, and not used
                late = (at >= 0) & ((part["us"] < held.us[at]) | ((part["us"] == held.us[at]) & (part["id"] <= held.id[at])))
                if late.any():
                    yield self._frame([_rows(part[late], "late", None, np.nan)])
                part = part[~late]
            self._wait(held, part)
        yield from self._drain(held, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = _Held(len(self.columns), self.held.get())
        if held.timer == expiredTimerInfo.getExpiryTimeInMs():
            held.timer = None  # it is gone
        yield from self._drain(held, timerValues.getCurrentWatermarkInMs())

    def _readings(self, chunk: pd.DataFrame) -> np.ndarray:
        part = np.empty(len(chunk), dtype=self.kind)
        part["machine"], part["station"] = _texts(chunk["machine_id"]), _texts(chunk["station_id"])
        part["us"] = chunk["timestamp"].astype("datetime64[us]").astype("int64")
        part["id"] = chunk["id"].fillna(NO_ID)  # sorts last
        part["line_id"] = _texts(chunk["line_id"])
        for i, c in enumerate(self.columns):
            part["x"][:, i] = pd.to_numeric(chunk[c], errors="coerce")
        return part

    def _wait(self, held: _Held, part: np.ndarray) -> None:
        """Readings wait in entries that follow one another in time, each under the bucket of its first."""
        if len(part) > ENTRY_ROWS:
            part = part[np.argsort(part["us"], kind="stable")]
        for i in range(0, len(part), ENTRY_ROWS):
            entry = part[i:i + ENTRY_ROWS]
            first = int(entry["us"].min())
            self.waiting.updateValue((first // self.bucket_us, held.entries), (pickle.dumps(entry, protocol=5),))
            held.entries += 1
            held.first = first if held.first is None else min(held.first, first)

    # -- in order of time --------------------------------------------------
    def _drain(self, held: _Held, watermark_ms: int) -> Iterator[pd.DataFrame]:
        """Takes all readings up to the watermark: none before it can come any more."""
        now, told = watermark_ms * 1000, []
        if held.first is not None and held.first <= now:
            entries = sorted(self.waiting.keys())
            due = [e for e in entries if e[0] * self.bucket_us <= now]
            held.first = entries[len(due)][0] * self.bucket_us if len(due) < len(entries) else None
            pool, k = np.empty(0, dtype=self.kind), 0
            while k < len(due):
                parts = [pool]
                # whole buckets, so that no reading that is still to be loaded is before those that are taken
                while k < len(due) and (len(parts) == 1 or sum(map(len, parts)) < TAKE_ROWS or due[k][0] == due[k - 1][0]):
                    parts.append(pickle.loads(self.waiting.getValue(due[k])[0]))
                    self.waiting.removeKey(due[k])
                    k += 1
                pool = np.concatenate(parts)
                ready = pool["us"] <= now
                if k < len(due):
                    ready &= pool["us"] < due[k][0] * self.bucket_us
                part, pool = pool[ready], pool[~ready]
                if len(part):
                    told += self._take(held, part)
                if sum(len(t[2]) for t in told) >= TAKE_ROWS:
                    yield self._frame(told)
                    told = []
            self._wait(held, pool)
        fell = ~held.silent & (held.us + self.gap_us <= now)
        if fell.any():
            told.append(self._silent(held, np.flatnonzero(fell)))
            held.silent |= fell
        gone = held.us + self.forget_us <= now
        if gone.any():
            held.forget(gone)
        if told:
            yield self._frame(told)
        self._keep(held)

    def _keep(self, held: _Held) -> None:
        """Stores what lasts, and sets the one timer: the next reading's turn, silence or forgetting."""
        turns = [] if held.first is None else [held.first]
        if held.names:
            turns.append(int((held.us + np.where(held.silent, self.forget_us, min(self.gap_us, self.forget_us))).min()))
        timer = math.ceil(min(turns) / 1000) if turns else None
        if timer != held.timer:
            if held.timer is not None:
                self.handle.deleteTimer(held.timer)
            if timer is not None:
                self.handle.registerTimer(timer)
            held.timer = timer
        if turns:
            self.held.update(held.row())
        else:
            self.held.clear()

    def _take(self, held: _Held, part: np.ndarray) -> list[tuple]:
        """What some readings, none of which is before one that was taken, tell; the last of each machine is held."""
        found: dict[tuple, int] = {}
        codes = np.fromiter((found.setdefault(name, len(found)) for name in _names(part)), dtype="i8", count=len(part))
        order = np.lexsort((part["id"], part["us"], codes))
        part, codes, names = part[order], codes[order], list(found)
        first = np.r_[True, codes[1:] != codes[:-1]]
        last = np.r_[first[1:], True]
        place = held.find(names)[codes]
        known = first & (place >= 0)
        us, told = part["us"], []
        before = np.r_[us[0], us[:-1]]
        before[first] = us[first]
        before[known] = held.us[place[known]]
        gap = us - before
        wide = gap > self.gap_us
        if wide.any():
            told.append(_rows(part[wide], "gap", None, gap[wide] / 1e6))
            # the reading before each gap, unless its silence was told already
            inside = part[:-1][(wide & ~first)[1:]]
            if len(inside):
                told.append(_rows(inside, "silent", None, self.gap_seconds))
            ended = place[wide & known]
            ended = ended[~held.silent[ended]]
            if len(ended):
                told.append(self._silent(held, ended))
        values, runs = part["x"][last], np.zeros((len(names), len(self.columns)), dtype="i8")
        for i, c in enumerate(self.columns):
            x = part["x"][:, i]
            earlier, carried = np.r_[np.nan, x[:-1]], np.zeros(len(x), dtype="i8")
            earlier[first] = np.nan
            earlier[known], carried[known] = held.values[place[known], i], held.runs[place[known], i]
            same = np.abs(x - earlier) < self.tolerance  # null on either side: not the same
            run = _run_lengths_by(same, first, np.repeat(carried[first], np.diff(np.r_[np.flatnonzero(first), len(x)])))
            stuck = same & (run >= self.need)
            if stuck.any():
                told.append(_rows(part[stuck], "stuck", c, x[stuck]))
            runs[:, i] = run[last]
        end = part[last]
        # ``codes`` are sorted, so the last readings are in the order of ``names``
        held.put(names, end["us"], end["id"], end["line_id"], values, runs)
        return told

    # -- output ------------------------------------------------------------
    def _silent(self, held: _Held, at: np.ndarray) -> tuple:
        names = np.array([held.names[i] for i in at] + [(None, None)], dtype=object)[:-1]
        return names[:, 0], names[:, 1], held.us[at], held.id[at], held.line_id[at], "silent", None, self.gap_seconds

    @staticmethod
    def _frame(told: list[tuple]) -> pd.DataFrame:
        sizes = [len(t[2]) for t in told]
        machine, station, us, ids, lines = (np.concatenate([t[i] for t in told]) for i in range(5))
        kind, column = (np.repeat(np.array([t[i] for t in told], dtype=object), sizes) for i in (5, 6))
        value = np.concatenate([np.broadcast_to(np.asarray(t[7], dtype=float), n) for t, n in zip(told, sizes)])
        ids = pd.Series(ids).where(ids != NO_ID) if (ids == NO_ID).any() else ids
        out = pd.DataFrame({"machine_id": machine, "station_id": station, "line_id": lines, "id": ids,
                            "timestamp": us.astype("datetime64[us]"), "kind": kind, "column": column, "value": value})
        return out[MONITOR_OUTPUT.fieldNames()]

    def close(self) -> None:
        pass


def _names(part: np.ndarray) -> list[tuple]:
    return list(zip(part["machine"].tolist(), part["station"].tolist()))


def _rows(part: np.ndarray, kind: str, column: str | None, value) -> tuple:
    """(machine, station, us, id, line_id, kind, column, value) of some readings, a frame's worth of which leave together."""
    return part["machine"], part["station"], part["us"], part["id"], part["line_id"], kind, column, value


def machine_monitor(valid: DataFrame, gap_seconds: float, delay: str, columns: list[str] | None = None,
                    min_run: int = q.STUCK_MIN_RUN, tolerance: float = q.STUCK_TOLERANCE,
                    bucket_seconds: int = BUCKET_SECONDS, forget_seconds: float = FORGET_SECONDS) -> DataFrame:
    """Monitor rows of a stream of readings that is at most ``delay`` out of order.

    Readings without a time can't be ordered and are left to the row rules.
    A machine that is silent for ``forget_seconds`` is forgotten; its next reading is a first one.
    """
    cols = columns or q.STUCK_COLUMNS
    group = F.pmod(F.xxhash64("machine_id", "station_id"), F.lit(MONITOR_GROUPS))
    slim = valid.where("timestamp is not null").select(
        group.alias("machines"), "machine_id", "station_id", "line_id", "id", "timestamp", *cols)
    return slim.withWatermark("timestamp", delay).groupBy("machines").transformWithStateInPandas(
        MachineMonitor(cols, gap_seconds, min_run, tolerance, bucket_seconds, forget_seconds), MONITOR_OUTPUT, "Append", "EventTime")
