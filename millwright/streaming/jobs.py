"""Structured Streaming versions of the ingest and monitoring operators (ST-1..10).

Every job is ``readStream`` -> the same column operators as the batch path ->
a checkpointed sink, so a restarted or retried query resumes exactly where it
stopped.  State lives only where the semantics need it:

* duplicate event ids: ``foreachBatch`` anti-joins the ids stored so far (no id
  is forgotten); ``dropDuplicatesWithinWatermark`` where bounded state matters more;
* per-minute counts: each micro-batch writes its own, which add up whatever the
  order of arrival; an event-time window with watermark for low latency;
* gaps and flatlines per (machine, station): ``applyInPandasWithState`` holding
  last timestamp, last values and current run lengths -- a few numbers per key,
  by hash groups of keys;
* as-of enrichment and scoring: ``foreachBatch`` runs the batch operators on
  each micro-batch against the landed sensor table.
"""

from __future__ import annotations

import pickle
from datetime import timedelta
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from .. import schemas as S
from ..operators import asof, quality as q, scoring
from ..session import cut_lineage
from ..sources import ingest as ig

# ------------------------------------------------------------------ sources / sinks


def read_json_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """ST-1: raw lines of a landing folder (JSON per line); parsing happens downstream."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path).withColumn("source_file", F.input_file_name())


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                      fmt: str = "parquet") -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def run_available(writer, checkpoint: str, timeout_s: float | None = None):
    """Process everything available now, then stop (``trigger(availableNow=True)``).

    Waits until all of it is processed.  With ``timeout_s`` a query that takes
    longer is stopped and that is an error: its sink holds only part of the data.
    """
    q_ = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if timeout_s is None:
        q_.awaitTermination()
    elif not q_.awaitTermination(timeout_s):
        q_.stop()
        raise TimeoutError(f"the stream had not processed all available data after {timeout_s} s")
    if q_.exception() is not None:
        raise q_.exception()
    return q_


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch's rows in a folder of its own: written again by a replay, it replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def earlier_batches(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """What the micro-batches before this one have written; an empty frame like ``batch`` for the first."""
    if batch_id == 0:
        return batch.limit(0)
    return batch.sparkSession.read.parquet(path).where(F.col("batch_id") < batch_id).drop("batch_id")


# ------------------------------------------------------------------ ST-1 / ST-10 / ST-9
def parse_stream(lines: DataFrame, schema: T.StructType = S.SENSOR_SCHEMA,
                 required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Contract check on arrival: (valid rows, quarantine rows) -- the batch parser, unchanged."""
    return ig.parse_records(lines, schema, required or ig.SENSOR_REQUIRED_FIELDS)


def classify_stream(lines: DataFrame, schema: T.StructType = S.SENSOR_SCHEMA,
                    required: list[str] | None = None) -> DataFrame:
    """One parse per line on arrival: typed fields, ``reject_reasons``, ``is_valid``."""
    return ig.classify_records(lines, schema, required or ig.SENSOR_REQUIRED_FIELDS)


def with_ingest_metrics(classified: DataFrame, name: str = "ingest") -> DataFrame:
    """ST-9 delivery counters per micro-batch, reported in ``lastProgress['observedMetrics']``."""
    return classified.observe(name, F.count_if(F.col("is_valid")).alias("accepted"),
                              F.count_if(~F.col("is_valid")).alias("quarantined"),
                              F.max("timestamp").alias("latest_event"))


def quality_and_quarantine_writer(issues_path: str, quarantine_path: str, schema: T.StructType = S.SENSOR_SCHEMA):
    """foreachBatch: one parsed micro-batch -> issue rows and quarantine rows (ST-5, ST-10).

    The batch is persisted for its two writes only (a shared input), so each
    line is parsed once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            valid = b.where("is_valid").select(*schema.fieldNames())
            write_batch(stateless_quality(valid), issues_path, batch_id)
            write_batch(b.where("not is_valid").select("source_file", "raw_record", "reject_reasons"),
                        quarantine_path, batch_id)
        finally:
            b.unpersist()
    return write


# ------------------------------------------------------------------ ST-2
def dedupe_stream(stream: DataFrame, key: str = "event_id", watermark: str = "7 days") -> DataFrame:
    """Drop re-deliveries of an event id seen within the watermark; null ids always pass.

    State is bounded, and so is memory of ids: rows later than the watermark
    are dropped and older ids forgotten.  ``dedupe_writer`` does neither.
    """
    keyed = (stream.where(F.col(key).isNotNull()).withWatermark("timestamp", watermark)
             .dropDuplicatesWithinWatermark([key]))
    return keyed.unionByName(stream.where(F.col(key).isNull()))


def dedupe_writer(path: str, key: str = "event_id", arrival: list[str] | None = None, index=None):
    """foreachBatch: first write wins against everything stored so far, however old; null ids always pass.

    The stored ids are anti-joined, so no id is forgotten and no row is too late.
    With an ``index`` (``idindex.IdIndex``) only the partitions that may hold an
    id of the micro-batch are read; without one, the id column of the whole sink.
    """
    from .idindex import stored_ids

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = ig.idempotent_append(stored_ids(path, batch, batch_id, key, index), batch, key, arrival)
        write_batch(fresh, path, batch_id)
        if index:
            index.add(batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/batch_id={batch_id}"), batch_id)
    return write


# ------------------------------------------------------------------ ST-3
def minute_counts_writer(path: str):
    """foreachBatch: each micro-batch's own counts per minute and stream; ``summed_counts`` adds them up.

    Counts add up whatever the order of arrival, so late rows need no side
    output and rows without a time are counted under a null minute.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(F.date_trunc("minute", "timestamp").alias("minute"), "stream_type").agg(
            F.count(F.lit(1)).alias("records"))
        write_batch(counts, path, batch_id)
    return write


def summed_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).groupBy("minute", "stream_type").agg(F.sum("records").alias("records"))


def per_minute_counts(stream: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Windowed counts with bounded state; rows later than the watermark are dropped (see ``minute_counts_writer``)."""
    return (stream.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", "1 minute"), "stream_type")
            .agg(F.count(F.lit(1)).alias("records"))
            .select(F.col("window.start").alias("minute"), "stream_type", "records"))


# ------------------------------------------------------------------ ST-4 / ST-5
def stateless_quality(valid: DataFrame) -> DataFrame:
    """Row-local rules on arrival: missing values, impossible values, dropout, delay."""
    return q.row_local_issues(valid, q.SENSOR, S.SENSOR_REQUIRED_COLUMNS, q.SENSOR_VALUE_RULES, dropout=True)


# ------------------------------------------------------------------ ST-6
MONITOR_OUTPUT = T.StructType([
    T.StructField("machine_id", T.StringType()), T.StructField("station_id", T.StringType()),
    T.StructField("line_id", T.StringType()), T.StructField("id", T.LongType()),
    T.StructField("timestamp", T.TimestampType()), T.StructField("kind", T.StringType()),
    T.StructField("column", T.StringType()), T.StructField("value", T.DoubleType()),
])


#: Hash groups of machines: a call of the monitor has the rows and the state of a group's machines.
MONITOR_GROUPS = 1024
_MONITOR_STATE = "machines binary"


_EMPTY_MONITOR = pd.DataFrame({
    "machine_id": pd.Series(dtype="object"), "station_id": pd.Series(dtype="object"),
    "line_id": pd.Series(dtype="object"), "id": pd.Series(dtype="int64"),
    "timestamp": pd.Series(dtype="datetime64[ns]"), "kind": pd.Series(dtype="object"),
    "column": pd.Series(dtype="object"), "value": pd.Series(dtype="float64")})


def _run_lengths(same: np.ndarray, carried: int) -> np.ndarray:
    """Consecutive-true counts ending at each row, continuing a run of ``carried`` from state."""
    n = len(same)
    pos = np.arange(n)
    last_break = np.maximum.accumulate(np.where(~same, pos, -1))
    return np.where(same, np.where(last_break < 0, pos + 1 + carried, pos - last_break), 0)


def _run_lengths_by(same: np.ndarray, first: np.ndarray, carried: np.ndarray) -> np.ndarray:
    """``_run_lengths`` of keys that follow one another: ``first`` marks each one's first row, ``carried`` is by row."""
    pos = np.arange(len(same))
    begin = np.maximum.accumulate(np.where(first, pos, 0))
    last_break = np.maximum.accumulate(np.where(~same, pos, -1))
    return np.where(same, np.where(last_break < begin, pos - begin + 1 + carried, pos - last_break), 0)


def _texts(column: pd.Series) -> np.ndarray:
    return column.astype(object).where(column.notna(), None).to_numpy()


def _monitor_fn(columns: list[str], gap_seconds: float, min_run: int, tol: float = q.STUCK_TOLERANCE):
    """The monitor of some machines at once: a call costs more than the rows of most machines.

    State: the machines met so far and, for each, last time and id, last values and current run lengths.
    """
    need = max(min_run - 1, 1)
    names = [f.name for f in MONITOR_OUTPUT.fields]
    k = len(columns)

    def fn(key, pdfs: Iterator[pd.DataFrame], state):
        if state.exists:
            met, last_us, last_id, vals, runs = pickle.loads(state.get[0])
        else:
            met, last_us, last_id, vals, runs = {}, np.empty(0, "i8"), np.empty(0, "i8"), np.empty((0, k)), np.empty((0, k), "i8")
        chunks = list(pdfs)
        pdf = chunks[0] if len(chunks) == 1 else pd.concat(chunks, ignore_index=True)
        machines, stations = _texts(pdf["machine_id"]), _texts(pdf["station_id"])
        old = len(met)
        who = np.fromiter((met.setdefault(m, len(met)) for m in zip(machines, stations)), dtype="i8", count=len(pdf))
        new = len(met) - old
        has = np.arange(len(met)) < old  # machines with a last reading
        last_us, last_id = np.r_[last_us, np.zeros(new, "i8")], np.r_[last_id, np.zeros(new, "i8")]
        vals, runs = np.vstack([vals, np.full((new, k), np.nan)]), np.vstack([runs, np.zeros((new, k), "i8")])
        stamps = pdf["timestamp"].to_numpy().astype("datetime64[us]")
        no_time = np.isnat(stamps)
        us = np.where(no_time, np.iinfo("i8").min // 1000, stamps.astype("int64"))
        ids = pdf["id"].to_numpy()
        # Arrival order inside a micro-batch is not guaranteed: order by event time, rows without one last.
        order = np.lexsort((ids, us, no_time, who))
        who, us, ids, stamps, lines = who[order], us[order], ids[order], stamps[order], pdf["line_id"].to_numpy()[order]
        machines, stations = machines[order], stations[order]
        x = np.empty((len(us), k))
        for i, c in enumerate(columns):
            x[:, i] = pd.to_numeric(pdf[c], errors="coerce")
        x = x[order]
        parts = []  # (rows, kind, column, value)
        late = has[who] & ((us < last_us[who]) | ((us == last_us[who]) & (ids < last_id[who])))
        if late.any():
            parts.append((np.flatnonzero(late), "late", None, np.nan))
        rest = np.flatnonzero(~late)
        if len(rest):
            t, w = us[rest], who[rest]
            first = np.r_[True, w[1:] != w[:-1]]
            prev_us = np.where(first, last_us[w], np.r_[0, t[:-1]])
            gap = (t - prev_us) / 1e6
            g = (~first | has[w]) & (gap > gap_seconds)
            if g.any():
                parts.append((rest[g], "gap", None, gap[g]))
            ends = np.r_[np.flatnonzero(first)[1:] - 1, len(t) - 1]
            for i, c in enumerate(columns):
                v = x[rest, i]
                prev = np.where(first, vals[w, i], np.r_[np.nan, v[:-1]])
                same = np.abs(v - prev) < tol  # NaN on either side -> False
                rl = _run_lengths_by(same, first, runs[w, i])
                hit = same & (rl >= need)
                if hit.any():
                    parts.append((rest[hit], "stuck", c, v[hit]))
                vals[w[ends], i], runs[w[ends], i] = v[ends], rl[ends]
            last_us[w[ends]], last_id[w[ends]] = t[ends], ids[rest[ends]]
        state.update((pickle.dumps((met, last_us, last_id, vals, runs), protocol=5),))
        if not parts:
            yield _EMPTY_MONITOR
            return
        at = np.concatenate([p[0] for p in parts])
        sizes = [len(p[0]) for p in parts]
        kind, column = (np.repeat(np.array([p[j] for p in parts], dtype=object), sizes) for j in (1, 2))
        value = np.concatenate([np.broadcast_to(np.asarray(p[3], dtype=float), n) for p, n in zip(parts, sizes)])
        yield pd.DataFrame({"machine_id": machines[at], "station_id": stations[at], "line_id": lines[at], "id": ids[at],
                            "timestamp": stamps[at], "kind": kind, "column": column, "value": value})[names]

    return fn


def gap_stuck_monitor(valid: DataFrame, gap_seconds: float, columns: list[str] | None = None,
                      min_run: int = q.STUCK_MIN_RUN) -> DataFrame:
    """Per (machine, station) state: emits ``gap``, ``stuck`` and ``late`` rows as data arrives.

    Machines are dealt over hash groups, each of which is one call and one row of state.
    """
    cols = columns or q.STUCK_COLUMNS
    group = F.pmod(F.xxhash64("machine_id", "station_id"), F.lit(MONITOR_GROUPS)).alias("_group")
    slim = valid.select(group, "machine_id", "station_id", "line_id", "id", "timestamp", *cols)
    return slim.groupBy("_group").applyInPandasWithState(
        _monitor_fn(cols, gap_seconds, min_run), MONITOR_OUTPUT, _MONITOR_STATE, "append",
        GroupStateTimeout.NoTimeout)


def stuck_report(monitor_rows: DataFrame) -> DataFrame:
    """Last stuck row per (machine, station, column), as the batch rule reports it (aggregate)."""
    stuck = monitor_rows.where(F.col("kind") == "stuck")
    return (stuck.groupBy("machine_id", "station_id", "column")
            .agg(F.max_by(F.struct("line_id", "id", "timestamp", "value"), F.struct("timestamp", "id")).alias("_r"))
            .select("machine_id", "station_id", "column", "_r.*"))


# ------------------------------------------------------------------ ST-7 / ST-8
def asof_batch_writer(sensor_table: DataFrame, out_path: str, tolerance_seconds: float):
    """foreachBatch: enrich each micro-batch of events with the batch as-of operator.

    Only readings that the batch can match are scanned: those from the
    tolerance before its first event to its last one.  A ``reading_date``
    column (the landed table's partition) prunes whole folders.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            span = b.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
            near = sensor_table
            if span["lo"] is not None:
                lo, hi = span["lo"] - timedelta(seconds=tolerance_seconds), span["hi"]
                near = near.where(F.col("timestamp").between(F.lit(lo), F.lit(hi)))
                if "reading_date" in near.columns:
                    near = near.where(F.col("reading_date").between(F.to_date(F.lit(lo)), F.to_date(F.lit(hi))))
            else:
                near = near.limit(0)
            write_batch(asof.asof_join(near.drop("reading_date"), b, tolerance_seconds), out_path, batch_id)
        finally:
            b.unpersist()
    return write


def score_batch_writer(root: str, score=scoring.score):
    """foreachBatch: score once, then write predictions, alerts and hints, all or nothing (``commits``).

    ``score`` takes the micro-batch to scored rows: the column rules for rows that hold
    model outputs, or ``predict.bundle_scorer`` to run fitted models.
    """
    from .commits import committed_writer

    def outputs(batch: DataFrame) -> dict[str, DataFrame]:
        scored = cut_lineage(score(batch).drop("risk_components"))
        hints = scored.select("id", "machine_id", "line_id", "station_id", "timestamp", F.col("diagnostic_hint").alias("hint"),
                              F.col("hint_action").alias("recommended_action"))
        return {"predictions": scored, "alerts": scoring.alerts(scored, source="stream_scoring"), "hints": hints}
    return committed_writer(root, outputs)
