"""History-only engineered features, risk index and synthetic labels (FT-1..18).

Input grain: one row per matched production event (output of the as-of
join).  Machine windows (M) run per (machine_id, station_id); station windows
(S) per (line_id, station_id) ordered by (timestamp, machine_id, id).  Trailing
frames exclude the current row (``rowsBetween(-n, -1)``), so a feature never
sees the current or a later row.  All windows are bounded row frames and run
over ``sequence.chunked`` layouts, never over a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.coerce import clip, clip01, finite_or_null, safe_div, to_double
from ..functions.timefn import seconds_between
from . import sequence as seq

EPS = 1e-6
MACHINE_KEYS = ["machine_id", "station_id"]
STATION_KEYS = ["line_id", "station_id"]
LABEL_HORIZON = 6  # rows ahead for the synthetic failure window (fixed value)

# Risk-index weights and scales.
RISK_WEIGHTS = {"tool_wear": 0.24, "vibration": 0.24, "temperature": 0.13,
                "defect": 0.17, "stability": 0.14, "downtime": 0.08}


def _tie(df: DataFrame) -> str:
    return "id_prod" if "id_prod" in df.columns else "id"


def prepare(df: DataFrame) -> DataFrame:
    """PRJ-3 + PRJ-1: absent inputs get defaults, string inputs become numbers."""
    cols = S.SENSOR_FEATURE_COLUMNS + S.PROCESS_STATE_FEATURE_COLUMNS + S.QUALITY_INPUT_COLUMNS
    add = {c: F.lit(1.0 if c in S.DEFAULT_ONE_COLUMNS else 0.0) for c in cols if c not in df.columns}
    out = df.withColumns(add) if add else df
    conv = {f.name: to_double(f.name) for f in out.schema.fields
            if f.name in cols and isinstance(f.dataType, T.StringType)}
    return out.withColumns(conv) if conv else out


def row_features(df: DataFrame) -> DataFrame:
    """FT-1..5, FT-11..14: row-local arithmetic."""
    c = F.col
    speed = F.abs(c("rotational_speed"))
    runtime_min = clip(c("cycle_time_sec") * c("throughput_count"), lo=1.0) / 60.0
    return df.withColumns({
        "temperature_delta": c("process_temperature") - c("air_temperature"),
        "vibration_severity_index": F.sqrt(F.pow(F.coalesce(c("vibration_rms"), F.lit(0.0)), 2)
                                           + F.pow(F.coalesce(c("vibration_peak"), F.lit(0.0)) / 3.0, 2)),
        "torque_per_speed": safe_div(c("torque"), speed + EPS),
        "motor_load_index": safe_div(c("motor_current") * c("torque"), speed + 1.0),
        "power_efficiency_index": safe_div(c("throughput_count"), F.abs(c("power_consumption")) + EPS),
        "throughput_gap": F.coalesce((c("target_throughput") - c("throughput_count")).cast("double"), F.lit(0.0)),
        "micro_stop_rate": safe_div(c("micro_stop_count"), F.abs(c("throughput_count")) + 1.0),
        "downtime_ratio": safe_div(c("downtime_minutes"), runtime_min + EPS),
        "queue_pressure_index": safe_div(c("queue_length"),
                                         F.abs(c("wip_count")) + F.abs(c("throughput_count")) + 1.0),
    })


def risk_index(df: DataFrame) -> DataFrame:
    """FT-15: weighted, clipped operational risk in [0, 1] (null-propagating)."""
    c = F.col
    w = RISK_WEIGHTS
    total = (w["tool_wear"] * clip01(c("tool_wear") / 100.0)
             + w["vibration"] * clip01(c("vibration_severity_index") / 6.0)
             + w["temperature"] * clip01(F.abs(c("temperature_delta")) / 55.0)
             + w["defect"] * clip01(c("defect_rate") / 0.15)
             + w["stability"] * clip01(1.0 - c("process_stability_index"))
             + w["downtime"] * clip01(c("downtime_ratio")))
    return df.withColumn("equipment_process_risk_index", clip01(total))


# ------------------------------------------------------------ FT-18 helpers
def trailing_mean(value: str, window) -> Column:
    return F.avg(F.col(value)).over(window)


def trailing_std(value: str, window) -> Column:
    # stddev_samp is null for a single value, matching a 2-value minimum.
    return F.stddev_samp(F.col(value)).over(window)


def diff_per_hour(value: str, win, ts: str = "timestamp") -> Column:
    dv = F.col(value) - F.lag(value, 1).over(win)
    dh = seconds_between(F.col(ts), F.lag(ts, 1).over(win)) / 3600.0
    return finite_or_null(safe_div(dv, F.when(dh != 0, dh)))


def machine_history(df: DataFrame, rolling_window: int = 12, chunk_rows: int = seq.DEFAULT_CHUNK_ROWS,
                    with_labels: bool = True) -> DataFrame:
    """FT-6..8 and FT-16 over machine windows."""
    keys = [k for k in MACHINE_KEYS if k in df.columns] or ["station_id"]
    order = ["timestamp", _tie(df)]
    after = LABEL_HORIZON if with_labels else 0
    ch = seq.chunked(df, keys, order, before=rolling_window, after=after, chunk_rows=chunk_rows)
    w = seq.chunk_window(keys)
    trail = w.rowsBetween(-rolling_window, -1)
    c = F.col
    out = ch.withColumns({
        "tool_wear_rate": F.greatest(F.lit(0.0), F.coalesce(diff_per_hour("tool_wear", w), F.lit(0.0))),
        "rolling_vibration_mean": F.coalesce(trailing_mean("vibration_rms", trail), c("vibration_rms")),
        "rolling_temperature_std": F.coalesce(trailing_std("process_temperature", trail), F.lit(0.0)),
    })
    if with_labels:
        def ahead(name):
            return F.lead(name, LABEL_HORIZON).over(w)
        fut = (F.coalesce(ahead("equipment_process_risk_index") >= 0.62, F.lit(False))
               | (F.coalesce(ahead("tool_wear") >= 82.0, F.lit(False))
                  & F.coalesce(ahead("vibration_rms") >= 3.5, F.lit(False))))
        out = out.withColumn("_future", fut.cast("int"))
    return seq.finish(out, keys)


def station_history(df: DataFrame, rolling_window: int = 12,
                    chunk_rows: int = seq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """FT-9, FT-10 over station windows, ordered by (timestamp, machine, id)."""
    keys = [k for k in STATION_KEYS if k in df.columns] or ["station_id"]
    order = ["timestamp"] + (["machine_id"] if "machine_id" in df.columns else []) + [_tie(df)]
    ch = seq.chunked(df, keys, order, before=rolling_window, chunk_rows=chunk_rows)
    trail = seq.chunk_window(keys).rowsBetween(-rolling_window, -1)
    c = F.col
    out = ch.withColumns({
        "cycle_time_drift": c("cycle_time_sec") - F.coalesce(trailing_mean("cycle_time_sec", trail),
                                                              c("cycle_time_sec")),
        "process_stability_trend": c("process_stability_index")
        - F.coalesce(trailing_mean("process_stability_index", trail), c("process_stability_index")),
    })
    return seq.finish(out, keys)


def labels(df: DataFrame) -> DataFrame:
    """FT-16/17: failure window and RUL target; existing labels are mirrored."""
    c = F.col
    if "failure_label" not in df.columns:
        df = df.withColumns({"future_failure_window": c("_future"), "failure_label": c("_future")})
    elif "future_failure_window" not in df.columns:
        df = df.withColumn("future_failure_window", c("failure_label").cast("int"))
    if "_future" in df.columns:
        df = df.drop("_future")
    has_t, has_e = "rul_target" in df.columns, "rul_estimate_hours" in df.columns
    if not has_t and not has_e:
        remaining = clip(100.0 - c("tool_wear"), lo=0.0)
        rate = F.when(c("tool_wear_rate") != 0, c("tool_wear_rate"))
        rul = clip(F.coalesce(safe_div(remaining, rate), remaining * 18.0), 0.0, 5000.0)
        df = df.withColumns({"rul_target": rul}).withColumn("rul_estimate_hours", c("rul_target"))
    elif has_t and not has_e:
        df = df.withColumn("rul_estimate_hours", c("rul_target"))
    elif has_e and not has_t:
        df = df.withColumn("rul_target", c("rul_estimate_hours"))
    return df


def add_engineered_features(joined: DataFrame, rolling_window: int = 12,
                            chunk_rows: int = seq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Full feature step: defaults, row features, risk, M and S history, labels."""
    df = risk_index(row_features(prepare(joined)))
    df = machine_history(df, rolling_window, chunk_rows, with_labels="failure_label" not in df.columns)
    df = station_history(df, rolling_window, chunk_rows)
    return _finished(labels(df))


def payload_features(payload: DataFrame) -> DataFrame:
    """The same features for rows that each stand alone, as single payloads do: no row is another's history.

    Row arithmetic only: no id, no ordering, no shuffle.
    """
    df = risk_index(row_features(prepare(payload)))
    c = F.col
    df = df.withColumns({
        "tool_wear_rate": F.lit(0.0), "rolling_vibration_mean": c("vibration_rms").cast("double"),
        "rolling_temperature_std": F.lit(0.0), "_future": F.lit(0),
        "cycle_time_drift": c("cycle_time_sec") - c("cycle_time_sec"),
        "process_stability_trend": c("process_stability_index") - c("process_stability_index"),
    })
    return _finished(labels(df))


def _finished(df: DataFrame) -> DataFrame:
    add = {col: F.lit(0.0) for col in S.FEATURE_COLUMNS if col not in df.columns}
    if add:
        df = df.withColumns(add)
    # PRJ-7: +/-inf never reaches a model.
    df = df.withColumns({col: finite_or_null(F.col(col).cast("double"))
                         if col in S.ENGINEERED_FEATURE_COLUMNS else F.col(col)
                         for col in S.FEATURE_COLUMNS})
    S.assert_no_leakage(S.FEATURE_COLUMNS)
    return df


def history(df: DataFrame, keys: list[str], order: list, window: int = 12,
            means: dict[str, str] | None = None, stds: dict[str, str] | None = None,
            rates: dict[str, str] | None = None, chunk_rows: int = seq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """FT-18 generic helpers in one bounded pass.

    ``means``/``stds``: output name -> column, over the ``window`` rows before
    the current one (mean needs 1 value, std 2).  ``rates``: output name ->
    column, change per hour versus the previous row (zero time step -> null).
    """
    means, stds, rates = means or {}, stds or {}, rates or {}
    ch = seq.chunked(df, keys, order, before=window, chunk_rows=chunk_rows)
    w = seq.chunk_window(keys)
    trail = w.rowsBetween(-window, -1)
    cols = {}
    cols.update({n: trailing_mean(c, trail) for n, c in means.items()})
    cols.update({n: trailing_std(c, trail) for n, c in stds.items()})
    cols.update({n: diff_per_hour(c, w) for n, c in rates.items()})
    return seq.finish(ch.withColumns(cols), keys)


def prepare_inference(df: DataFrame) -> DataFrame:
    """PRJ-4: inference defaults for absent *or null* production fields; event and
    sensor timestamps default to the record timestamp, the timestamp to now."""
    from ..functions.coerce import with_defaults

    out = df if "timestamp" in df.columns else df.withColumn("timestamp", F.current_timestamp())
    out = with_defaults(out, S.INFERENCE_DEFAULTS)
    for c in ("event_timestamp", "sensor_timestamp"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.col("timestamp")) if c in out.columns else F.col("timestamp"))
    return out
