"""Data-quality rules (DQ-1..12) as DataFrame -> issues DataFrame.

Every rule returns the common issue layout: ``issue_type, severity,
entity_type, entity_id, machine_id, line_id, station_id, timestamp`` plus a
rule-specific ``details`` struct.  ``to_issue_table`` turns ``details`` into
``details_json`` so the suites can union rules with different payloads.

Row-local rules (missing values, impossible values, dropout, delay) are a
single projection each.  The ordered rules (gaps, stuck sensors) share one
bounded chunked layout per (machine, station) -- see ``sequence``.  Duplicate
detection is a partial aggregate plus a join, so a huge group of copies is
split by AQE's skew-join handling instead of sorted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.coerce import identity_struct, to_double
from ..functions.timefn import seconds_between
from ..session import cut_lineage
from . import sequence as seq

SENSOR = "sensor_reading"
PRODUCTION = "production_event"


@dataclass(frozen=True)
class ValueRule:
    """A per-column validity rule: ``violates(col)`` is true for a bad value."""
    column: str
    violates: Callable[[Column], Column]
    issue_type: str = "impossible_value"
    severity: str = "high"


def _neg(c):
    return c < 0


def _out01(c):
    return (c < 0) | (c > 1)


def _out0_100(c):
    return (c < 0) | (c > 100)


def _nonpos(c):
    return c <= 0


# Physical validity rules for sensor readings (temperatures are not checked).
SENSOR_VALUE_RULES = [
    ValueRule("vibration_rms", _neg), ValueRule("vibration_peak", _neg), ValueRule("pressure", _neg),
    ValueRule("torque", _neg), ValueRule("rotational_speed", _neg), ValueRule("motor_current", _neg),
    ValueRule("power_consumption", _neg), ValueRule("tool_wear", _out0_100),
    ValueRule("operating_hours", _neg), ValueRule("production_load", _neg),
    ValueRule("ambient_humidity", _out0_100),
]

# Validity rules for production events.
PRODUCTION_VALUE_RULES = [
    ValueRule("station_yield", _out01), ValueRule("defect_rate", _out01),
    ValueRule("inspection_score_proxy", _out01), ValueRule("process_stability_index", _out01),
    ValueRule("cycle_time_sec", _nonpos), ValueRule("throughput_count", _neg),
    ValueRule("target_throughput", _neg), ValueRule("reject_count", _neg),
    ValueRule("rework_count", _neg), ValueRule("micro_stop_count", _neg),
    ValueRule("downtime_minutes", _neg), ValueRule("wip_count", _neg), ValueRule("queue_length", _neg),
]

# Columns watched for flatlines, and the dropout columns.
STUCK_COLUMNS = ["air_temperature", "process_temperature", "vibration_rms", "pressure", "torque",
                 "motor_current", "power_consumption"]
DROPOUT_COLUMNS = ["air_temperature", "process_temperature", "vibration_rms", "vibration_peak", "pressure",
                   "torque", "rotational_speed", "motor_current", "power_consumption"]

EXPECTED_INTERVAL_SECONDS = 300
GAP_MULTIPLIER = 6
STUCK_MIN_RUN = 6
STUCK_TOLERANCE = 1e-9
DROPOUT_MIN_MISSING = 5
MAX_DELAY_SECONDS = 60

ISSUE_COLUMNS = ["issue_type", "severity", "entity_type", "entity_id", "machine_id", "line_id",
                 "station_id", "timestamp"]


def _issue(df: DataFrame, issue_type: str, severity: str, entity_type: str, details: Column) -> DataFrame:
    return df.select(F.lit(issue_type).alias("issue_type"), F.lit(severity).alias("severity"),
                     F.lit(entity_type).alias("entity_type"), *identity_struct(df),
                     details.alias("details"))


def to_issue_table(issues: DataFrame) -> DataFrame:
    return issues.select(*ISSUE_COLUMNS, F.to_json("details").alias("details_json"))


def with_details(issues: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Issues of any rules with ``fields``: column name -> (path in the details, type).

    The details are read as a VARIANT, so rules with different payloads share
    one table; a field that a rule lacks, or that isn't of the type, is null.
    """
    parsed = issues.withColumn("_details", F.try_parse_json("details_json"))
    got = parsed.withColumns({name: F.try_variant_get("_details", path, kind) for name, (path, kind) in fields.items()})
    return got.drop("_details")


def flatten(issues: DataFrame) -> DataFrame:
    """Identity columns + the rule's detail fields as top-level columns."""
    return issues.select(*ISSUE_COLUMNS, "details.*")


# ---------------------------------------------------------------- DQ-1
def missing_required_columns(df: DataFrame, required: list[str], entity_type: str) -> DataFrame:
    """Schema diff on the driver (metadata only); one issue per absent column."""
    missing = [c for c in required if c not in df.columns]
    spark = df.sparkSession
    base = spark.createDataFrame([(c,) for c in missing], "column string")
    none = F.lit(None).cast("string")
    return base.select(F.lit("missing_required_column").alias("issue_type"), F.lit("critical").alias("severity"),
                       F.lit(entity_type).alias("entity_type"), none.alias("entity_id"),
                       none.alias("machine_id"), none.alias("line_id"), none.alias("station_id"),
                       F.lit(None).cast("timestamp").alias("timestamp"),
                       F.struct(F.col("column")).alias("details"))


# ---------------------------------------------------------------- DQ-2
def missing_values(df: DataFrame, required: list[str], entity_type: str) -> DataFrame:
    present = [c for c in required if c in df.columns]
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in present]))
    flagged = df.withColumn("_missing", names).where(F.size("_missing") > 0)
    return _issue(flagged, "missing_value", "high", entity_type,
                  F.struct(F.col("id").alias("row_id"), F.col("_missing").alias("missing_columns")))


# ---------------------------------------------------------------- DQ-3
def duplicate_timestamps(df: DataFrame, group_columns: list[str], entity_type: str) -> DataFrame:
    """Every member of a (group, timestamp) with more than one row; nulls equal."""
    subset = [c for c in group_columns + ["timestamp"] if c in df.columns]
    if "timestamp" not in df.columns or len(subset) < 2:
        return _issue(df.limit(0), "duplicate_timestamp", "medium", entity_type, F.struct(F.lit(None).alias("x")))
    dup_keys = (df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > 1).drop("_n"))
    d = dup_keys.select(*[F.col(c).alias(f"_k_{c}") for c in subset])
    cond = None
    for c in subset:
        e = df[c].eqNullSafe(d[f"_k_{c}"])
        cond = e if cond is None else cond & e
    members = df.join(d, cond, "inner").drop(*[f"_k_{c}" for c in subset])
    return _issue(members, "duplicate_timestamp", "medium", entity_type,
                  F.struct(*[F.col(c).cast("string").alias(c) for c in subset]))


# ---------------------------------------------------------------- DQ-4 / DQ-7 shared layout
def _sequence_flags(df: DataFrame, keys: list[str], gap_threshold: float | None,
                    stuck_columns: list[str], min_run: int, chunk_rows: int, dups: bool = False) -> DataFrame:
    """One chunked pass per (keys): gap seconds and per-column stuck flags.

    Stuck rows: ``same = |x - prev| < tol`` and the maximal stretch of ``same``
    rows containing the row has at least ``min_run - 1`` rows.  That holds iff
    some block of ``m = min_run - 1`` consecutive rows containing the row is
    all ``same`` -- a bounded test: ``a(i) = all same over [i, i+m-1]`` and
    ``stuck(r) = any a over [r-m+1, r]``.
    """
    m = max(min_run - 1, 1)
    before = max(1, m) if stuck_columns else 1
    after = max((m - 1) if stuck_columns else 0, 1 if dups else 0)
    ch = seq.chunked(df, keys, ["timestamp", "id"], before=before, after=after, chunk_rows=chunk_rows)
    w = seq.chunk_window(keys)
    cols: dict[str, Column] = {}
    if gap_threshold is not None:
        cols["_gap"] = seconds_between(F.col("timestamp"), F.lag("timestamp", 1).over(w))
    if dups:
        # Duplicates are neighbours in (timestamp, id) order; null timestamps are equal to each other.
        has_prev = F.lag(F.lit(1), 1).over(w).isNotNull()
        has_next = F.lead(F.lit(1), 1).over(w).isNotNull()
        cols["_dup"] = ((has_prev & F.col("timestamp").eqNullSafe(F.lag("timestamp", 1).over(w)))
                        | (has_next & F.col("timestamp").eqNullSafe(F.lead("timestamp", 1).over(w))))
    for c in stuck_columns:
        x = to_double(c)
        cols[f"_same_{c}"] = F.coalesce(F.abs(x - F.lag(x, 1).over(w)) < STUCK_TOLERANCE, F.lit(False))
    out = ch.withColumns(cols)
    if stuck_columns:
        fwd = w.rowsBetween(0, m - 1)
        back = w.rowsBetween(-(m - 1), 0)
        out = out.withColumns({
            f"_blk_{c}": (F.min(F.col(f"_same_{c}").cast("int")).over(fwd) == 1)
            & (F.count(F.lit(1)).over(fwd) == m) for c in stuck_columns})
        out = out.withColumns({
            f"_stuck_{c}": F.col(f"_same_{c}") & (F.max(F.col(f"_blk_{c}").cast("int")).over(back) == 1)
            for c in stuck_columns})
        out = out.drop(*[f"_same_{c}" for c in stuck_columns], *[f"_blk_{c}" for c in stuck_columns])
    return out.where(~F.col("_halo")).drop("_halo", "_chunk")


def _slim_flags(flags: DataFrame, keys: list[str], stuck_columns: list[str]) -> DataFrame:
    """Checkpoint just what the issue builders read: three consumers share it."""
    ident = [c for c in ["id", "machine_id", "line_id", "station_id", "timestamp"] if c in flags.columns]
    keep = list(dict.fromkeys(keys + ident + ["_seq", "_gap", "_dup"] + stuck_columns
                              + [f"_stuck_{c}" for c in stuck_columns]))
    return cut_lineage(flags.select(*[c for c in keep if c in flags.columns]))


def _dup_issues(flags: DataFrame, keys: list[str], entity_type: str) -> DataFrame:
    hit = seq.restore_keys(flags.where(F.col("_dup")), keys)
    subset = [*keys, "timestamp"]
    return _issue(hit, "duplicate_timestamp", "medium", entity_type,
                  F.struct(*[F.col(c).cast("string").alias(c) for c in subset]))


def _gap_issues(flags: DataFrame, keys: list[str], entity_type: str, threshold: float) -> DataFrame:
    hit = seq.restore_keys(flags.where(F.col("_gap") > threshold), keys)
    return _issue(hit, "timestamp_gap", "medium", entity_type, F.struct(
        F.array(*[F.lit(k) for k in keys]).alias("group_columns"),
        F.concat_ws("|", *[F.coalesce(F.col(k), F.lit("null")) for k in keys]).alias("group_key"),
        F.col("_gap").alias("gap_seconds"),
        F.lit(float(threshold)).alias("threshold_seconds")))


def _stuck_issues(flags: DataFrame, keys: list[str], columns: list[str], min_run: int) -> DataFrame:
    ident = identity_struct(flags)
    long = flags.select(
        *keys, "_seq", F.struct(*ident).alias("_id"),
        F.explode(F.array_compact(F.array(*[
            F.when(F.col(f"_stuck_{c}"), F.struct(F.lit(c).alias("column"), to_double(c).alias("value")))
            for c in columns]))).alias("_hit"))
    # Last stuck row per (machine, station, column): an aggregate, partial per task.
    last = (long.groupBy(*keys, F.col("_hit.column").alias("column"))
            .agg(F.max_by(F.struct("_id", F.col("_hit.value").alias("value")), "_seq").alias("_r")))
    last = seq.restore_keys(last, keys)
    return last.select(
        F.lit("stuck_sensor").alias("issue_type"), F.lit("high").alias("severity"),
        F.lit(SENSOR).alias("entity_type"), "_r._id.*",
        F.struct(F.col(keys[0]).alias(keys[0]), F.col(keys[1]).alias(keys[1]), F.col("column"),
                 F.lit(min_run).alias("min_run_length"), F.col("_r.value").alias("example_value"))
        .alias("details"))


def timestamp_gaps(df: DataFrame, group_columns: list[str], entity_type: str,
                   expected_interval_seconds: int = EXPECTED_INTERVAL_SECONDS,
                   gap_multiplier: int = GAP_MULTIPLIER,
                   chunk_rows: int = seq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """DQ-4: consecutive timestamps per group further apart than the threshold (strict >)."""
    threshold = float(expected_interval_seconds * gap_multiplier)
    flags = _sequence_flags(df, group_columns, threshold, [], STUCK_MIN_RUN, chunk_rows)
    return _gap_issues(flags, group_columns, entity_type, threshold)


def stuck_sensor(df: DataFrame, columns: list[str] | None = None, min_run_length: int = STUCK_MIN_RUN,
                 chunk_rows: int = seq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """DQ-7: flatlined sensors; one issue per (machine, station, column) at its last stuck row."""
    keys = ["machine_id", "station_id"]
    cols = [c for c in (columns or STUCK_COLUMNS) if c in df.columns]
    flags = _sequence_flags(df, keys, None, cols, min_run_length, chunk_rows)
    return _stuck_issues(flags, keys, cols, min_run_length)


def flatline_flags(sensor: DataFrame, columns: list[str] | None = None, min_run_length: int = STUCK_MIN_RUN,
                   chunk_rows: int = seq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Readings that sit inside a flatline run of any watched column: ``(id, flatline_sensor_flag=1)``.

    Feeds the hint rule and data-quality penalty, which read a flatline flag
    the source pipeline never computes (SURVEY Q6).
    """
    keys = ["machine_id", "station_id"]
    cols = [c for c in (columns or STUCK_COLUMNS) if c in sensor.columns]
    flags = _sequence_flags(sensor, keys, None, cols, min_run_length, chunk_rows)
    anyc = F.lit(False)
    for c in cols:
        anyc = anyc | F.col(f"_stuck_{c}")
    return flags.where(anyc).select("id", F.lit(1).alias("flatline_sensor_flag"))


def with_flatline(joined: DataFrame, sensor: DataFrame, sensor_id: str = "id") -> DataFrame:
    """Attach the flag to as-of joined rows by the matched sensor reading's id (0 when not flat)."""
    f = flatline_flags(sensor).withColumnRenamed("id", "_fid")
    return (joined.join(f, joined[sensor_id] == f["_fid"], "left").drop("_fid")
            .withColumn("flatline_sensor_flag", F.coalesce(F.col("flatline_sensor_flag"), F.lit(0))))


# ---------------------------------------------------------------- DQ-5 / DQ-6
def impossible_values(df: DataFrame, rules: list[ValueRule], entity_type: str) -> DataFrame:
    """One issue per (row, violated column), all rules in one projection."""
    present = [r for r in rules if r.column in df.columns]
    hits = F.array_compact(F.array(*[
        F.when(F.coalesce(r.violates(to_double(r.column)), F.lit(False)),
               F.struct(F.lit(r.column).alias("column"), to_double(r.column).alias("value")))
        for r in present]))
    exploded = df.withColumn("_hit", F.explode(hits))
    return _issue(exploded, "impossible_value", "high", entity_type,
                  F.struct(F.col("_hit.column").alias("column"), F.col("_hit.value").alias("value")))


def impossible_sensor_values(df: DataFrame) -> DataFrame:
    return impossible_values(df, SENSOR_VALUE_RULES, SENSOR)


def impossible_production_values(df: DataFrame) -> DataFrame:
    return impossible_values(df, PRODUCTION_VALUE_RULES, PRODUCTION)


# ---------------------------------------------------------------- DQ-8
def sensor_dropout(df: DataFrame, min_missing: int = DROPOUT_MIN_MISSING) -> DataFrame:
    present = [c for c in DROPOUT_COLUMNS if c in df.columns]
    n_missing = sum(F.col(c).isNull().cast("int") for c in present) if present else F.lit(0)
    flagged = df.withColumn("_n", n_missing).where(F.col("_n") >= min_missing)
    return _issue(flagged, "sensor_dropout", "high", SENSOR, F.struct(
        F.col("id").alias("row_id"), F.col("_n").alias("missing_sensor_columns"),
        F.lit(min_missing).alias("threshold")))


# ---------------------------------------------------------------- DQ-9
def delayed_readings(df: DataFrame, entity_type: str, max_delay_seconds: int = MAX_DELAY_SECONDS) -> DataFrame:
    if "timestamp" not in df.columns or "created_at" not in df.columns:
        return _issue(df.limit(0), "delayed_reading", "medium", entity_type,
                      F.struct(F.lit(None).cast("double").alias("delay_seconds"),
                               F.lit(max_delay_seconds).alias("threshold_seconds")))
    delay = seconds_between(F.col("created_at"), F.col("timestamp"))
    flagged = df.withColumn("_delay", delay).where(F.col("_delay") > max_delay_seconds)
    return _issue(flagged, "delayed_reading", "medium", entity_type, F.struct(
        F.col("_delay").alias("delay_seconds"), F.lit(max_delay_seconds).alias("threshold_seconds")))


# ---------------------------------------------------------------- fused row-local rules
def row_local_issues(df: DataFrame, entity_type: str, required: list[str], value_rules: list[ValueRule],
                     dropout: bool, max_delay_seconds: int = MAX_DELAY_SECONDS,
                     min_missing: int = DROPOUT_MIN_MISSING) -> DataFrame:
    """DQ-2, DQ-5/6, DQ-8 and DQ-9 in ONE projection + explode (one scan, one pass).

    Same rows and payloads as the single-rule functions, already in the issue
    table layout (``details_json``).
    """
    def item(cond, issue_type, severity, details):
        return F.when(F.coalesce(cond, F.lit(False)),
                      F.struct(F.lit(issue_type).alias("issue_type"), F.lit(severity).alias("severity"),
                               F.to_json(details).alias("details_json")))

    present = [c for c in required if c in df.columns]
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in present]))
    items = [item(F.size(missing) > 0, "missing_value", "high",
                  F.struct(F.col("id").alias("row_id"), missing.alias("missing_columns")))]
    for r in [r for r in value_rules if r.column in df.columns]:
        v = to_double(r.column)
        items.append(item(r.violates(v), r.issue_type, r.severity,
                          F.struct(F.lit(r.column).alias("column"), v.alias("value"))))
    if dropout:
        cols = [c for c in DROPOUT_COLUMNS if c in df.columns]
        n_missing = sum(F.col(c).isNull().cast("int") for c in cols) if cols else F.lit(0)
        items.append(item(n_missing >= min_missing, "sensor_dropout", "high",
                          F.struct(F.col("id").alias("row_id"), n_missing.alias("missing_sensor_columns"),
                                   F.lit(min_missing).alias("threshold"))))
    if "timestamp" in df.columns and "created_at" in df.columns:
        delay = seconds_between(F.col("created_at"), F.col("timestamp"))
        items.append(item(delay > max_delay_seconds, "delayed_reading", "medium",
                          F.struct(delay.alias("delay_seconds"), F.lit(max_delay_seconds).alias("threshold_seconds"))))
    hits = df.select(*identity_struct(df), F.explode(F.array_compact(F.array(*items))).alias("_i"))
    return hits.select("_i.issue_type", "_i.severity", F.lit(entity_type).alias("entity_type"),
                       "entity_id", "machine_id", "line_id", "station_id", "timestamp", "_i.details_json")


# ---------------------------------------------------------------- DQ-10 / DQ-11
def empty_table_issue(df: DataFrame, entity_type: str, table: str) -> DataFrame:
    """DQ-10: the single issue reported for a table without rows."""
    none = F.lit(None).cast("string")
    return df.sparkSession.range(1).select(
        F.lit("empty_table").alias("issue_type"), F.lit("medium").alias("severity"),
        F.lit(entity_type).alias("entity_type"), none.alias("entity_id"), none.alias("machine_id"),
        none.alias("line_id"), none.alias("station_id"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.to_json(F.struct(F.lit(f"{table} table is empty").alias("message"))).alias("details_json"))


def validate_sensor_readings(df: DataFrame, chunk_rows: int = seq.DEFAULT_CHUNK_ROWS,
                             gap_interval_seconds: int = EXPECTED_INTERVAL_SECONDS) -> DataFrame:
    """DQ-11 sensor suite: 1, 2, 3, 4, 5, 7, 8, 9 (issues with details_json)."""
    keys = ["machine_id", "station_id"]
    threshold = float(gap_interval_seconds * GAP_MULTIPLIER)
    stuck_cols = [c for c in STUCK_COLUMNS if c in df.columns]
    parts = [missing_required_columns(df, S.SENSOR_REQUIRED_COLUMNS, SENSOR)]
    if "timestamp" in df.columns and all(k in df.columns for k in keys):
        # Duplicates, gaps and flatlines share one chunked layout (one sequence, one sort).
        flags = _slim_flags(_sequence_flags(df, keys, threshold, stuck_cols, STUCK_MIN_RUN, chunk_rows, dups=True),
                            keys, stuck_cols)
        parts.append(_dup_issues(flags, keys, SENSOR))
        parts.append(_gap_issues(flags, keys, SENSOR, threshold))
        if stuck_cols:
            parts.append(_stuck_issues(flags, keys, stuck_cols, STUCK_MIN_RUN))
    else:
        parts.append(duplicate_timestamps(df, keys, SENSOR))
    fused = row_local_issues(df, SENSOR, S.SENSOR_REQUIRED_COLUMNS, SENSOR_VALUE_RULES, dropout=True)
    return _suite(df, parts, SENSOR, "sensor_readings", fused)


def validate_production_events(df: DataFrame, chunk_rows: int = seq.DEFAULT_CHUNK_ROWS,
                               gap_interval_seconds: int = EXPECTED_INTERVAL_SECONDS) -> DataFrame:
    """DQ-11 production suite: 1, 2, 3, 4, 6, 9."""
    keys = ["line_id", "station_id"]
    parts = [missing_required_columns(df, S.PRODUCTION_REQUIRED_COLUMNS, PRODUCTION)]
    if "timestamp" in df.columns and all(k in df.columns for k in keys):
        threshold = float(gap_interval_seconds * GAP_MULTIPLIER)
        flags = _slim_flags(_sequence_flags(df, keys, threshold, [], STUCK_MIN_RUN, chunk_rows, dups=True), keys, [])
        parts += [_dup_issues(flags, keys, PRODUCTION), _gap_issues(flags, keys, PRODUCTION, threshold)]
    else:
        parts.append(duplicate_timestamps(df, keys, PRODUCTION))
    fused = row_local_issues(df, PRODUCTION, S.PRODUCTION_REQUIRED_COLUMNS, PRODUCTION_VALUE_RULES, dropout=False)
    return _suite(df, parts, PRODUCTION, "production_events", fused)


def _suite(df: DataFrame, parts: list[DataFrame], entity_type: str, table: str,
           fused: DataFrame | None = None) -> DataFrame:
    # An empty table reports only ``empty_table``.  isEmpty() reads at most one row.
    if df.isEmpty():
        return empty_table_issue(df, entity_type, table)
    out = fused
    for p in parts:
        t = to_issue_table(p)
        out = t if out is None else out.unionByName(t)
    return out


# ---------------------------------------------------------------- DQ-12
def run_quality_checks(sensor: DataFrame, production: DataFrame,
                       chunk_rows: int = seq.DEFAULT_CHUNK_ROWS,
                       gap_interval_seconds: int = EXPECTED_INTERVAL_SECONDS) -> DataFrame:
    """Both suites as one issue table."""
    return validate_sensor_readings(sensor, chunk_rows, gap_interval_seconds).unionByName(
        validate_production_events(production, chunk_rows, gap_interval_seconds))


def quality_summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("entity_type", "issue_type").agg(F.count(F.lit(1)).alias("issue_count"))


def with_run(issues: DataFrame, run_id: str) -> DataFrame:
    """Tag a run so a sink can overwrite its own partition (no accumulation)."""
    return issues.withColumns({"run_id": F.lit(run_id), "detected_at": F.current_timestamp()})

