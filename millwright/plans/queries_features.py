"""Registered feature queries (FT-1..18) and their oracles."""

from __future__ import annotations

from ..operators import features as ft
from . import tables as t
from .catalog import register
from .queries_core import joined
from .sqlfrag import ASOF_CTES, clip, clip01

M_WIN = 'PARTITION BY machine_id, station_id ORDER BY "timestamp", id_prod'
S_WIN = 'PARTITION BY line_id, station_id ORDER BY "timestamp", machine_id, id_prod'
SENSOR_WIN = 'PARTITION BY machine_id, station_id ORDER BY "timestamp", id'
TRAIL = "ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING"

_rate = ('(tool_wear - lag(tool_wear) OVER ({w})) / nullif((epoch_us("timestamp") - '
         'epoch_us(lag("timestamp") OVER ({w}))) / 3.6e9, 0)')

ROW_FEATURES = f"""
row_f AS (
  SELECT *,
    process_temperature - air_temperature AS temperature_delta,
    sqrt(pow(coalesce(vibration_rms, 0.0), 2) + pow(coalesce(vibration_peak, 0.0) / 3.0, 2)) AS vibration_severity_index,
    torque / (abs(rotational_speed) + 1e-6) AS torque_per_speed,
    motor_current * torque / (abs(rotational_speed) + 1.0) AS motor_load_index,
    throughput_count / (abs(power_consumption) + 1e-6) AS power_efficiency_index,
    coalesce(CAST(target_throughput - throughput_count AS DOUBLE), 0.0) AS throughput_gap,
    micro_stop_count / (abs(throughput_count) + 1.0) AS micro_stop_rate,
    downtime_minutes / ({clip('cycle_time_sec * throughput_count', lo='1.0')} / 60.0 + 1e-6) AS downtime_ratio,
    queue_length / (abs(wip_count) + abs(throughput_count) + 1.0) AS queue_pressure_index
  FROM joined
),
risk_f AS (
  SELECT *, {clip01(
      "0.24 * " + clip01("tool_wear / 100.0")
      + " + 0.24 * " + clip01("vibration_severity_index / 6.0")
      + " + 0.13 * " + clip01("abs(temperature_delta) / 55.0")
      + " + 0.17 * " + clip01("defect_rate / 0.15")
      + " + 0.14 * " + clip01("1.0 - process_stability_index")
      + " + 0.08 * " + clip01("downtime_ratio"))} AS equipment_process_risk_index
  FROM row_f
),
hist_f AS (
  SELECT *,
    greatest(0.0, coalesce({_rate.format(w=M_WIN)}, 0.0)) AS tool_wear_rate,
    coalesce(avg(vibration_rms) OVER ({M_WIN} {TRAIL}), vibration_rms) AS rolling_vibration_mean,
    coalesce(stddev_samp(process_temperature) OVER ({M_WIN} {TRAIL}), 0.0) AS rolling_temperature_std,
    CAST(coalesce(lead(equipment_process_risk_index, 6) OVER ({M_WIN}) >= 0.62, false)
         OR (coalesce(lead(tool_wear, 6) OVER ({M_WIN}) >= 82.0, false)
             AND coalesce(lead(vibration_rms, 6) OVER ({M_WIN}) >= 3.5, false)) AS INTEGER) AS future_failure_window,
    cycle_time_sec - coalesce(avg(cycle_time_sec) OVER ({S_WIN} {TRAIL}), cycle_time_sec) AS cycle_time_drift,
    process_stability_index - coalesce(avg(process_stability_index) OVER ({S_WIN} {TRAIL}),
                                       process_stability_index) AS process_stability_trend
  FROM risk_f
),
feat AS (
  SELECT *, future_failure_window AS failure_label,
    {clip("coalesce(" + clip("100.0 - tool_wear", lo="0.0") + " / nullif(tool_wear_rate, 0.0), "
          + clip("100.0 - tool_wear", lo="0.0") + " * 18.0)", "0.0", "5000.0")} AS rul_target
  FROM hist_f
)
"""

ENGINEERED = ["temperature_delta", "vibration_severity_index", "torque_per_speed", "motor_load_index",
              "power_efficiency_index", "tool_wear_rate", "rolling_vibration_mean", "rolling_temperature_std",
              "cycle_time_drift", "throughput_gap", "micro_stop_rate", "downtime_ratio", "queue_pressure_index",
              "process_stability_trend"]
KEY_OUT = ["id_prod", "machine_id", "line_id", "station_id", "timestamp"]


def _keys_sql():
    return ", ".join(f'"{k}"' if k == "timestamp" else k for k in KEY_OUT)


def _feats(spark, sf):
    return ft.add_engineered_features(joined(spark, sf))


@register("engineered_features", sql=f"""
SELECT {_keys_sql()}, {", ".join(f"round({c}, 6) AS {c}" for c in ENGINEERED)},
       round(equipment_process_risk_index, 6) AS equipment_process_risk_index
FROM feat
""", extra_ctes=ASOF_CTES + "," + ROW_FEATURES)
def q_engineered_features(spark, sf):
    """FT-1..15 on as-of joined events (M and S history windows)."""
    return _feats(spark, sf).select(*KEY_OUT, *ENGINEERED, "equipment_process_risk_index")


@register("risk_index", sql=f"""
SELECT {_keys_sql()}, round(vibration_severity_index, 6) AS vibration_severity_index,
       round(downtime_ratio, 6) AS downtime_ratio,
       round(equipment_process_risk_index, 6) AS equipment_process_risk_index
FROM risk_f
""", extra_ctes=ASOF_CTES + "," + ROW_FEATURES)
def q_risk_index(spark, sf):
    """FT-15: row-local risk index (no windows)."""
    df = ft.risk_index(ft.row_features(ft.prepare(joined(spark, sf))))
    return df.select(*KEY_OUT, "vibration_severity_index", "downtime_ratio", "equipment_process_risk_index")


@register("failure_labels", sql=f"""
SELECT {_keys_sql()}, future_failure_window, failure_label FROM feat
""", extra_ctes=ASOF_CTES + "," + ROW_FEATURES)
def q_failure_labels(spark, sf):
    """FT-16: failure window 6 events ahead per machine."""
    return _feats(spark, sf).select(*KEY_OUT, "future_failure_window", "failure_label")


@register("rul_target", sql=f"""
SELECT {_keys_sql()}, round(tool_wear_rate, 6) AS tool_wear_rate, round(rul_target, 6) AS rul_target,
       round(rul_target, 6) AS rul_estimate_hours FROM feat
""", extra_ctes=ASOF_CTES + "," + ROW_FEATURES)
def q_rul_target(spark, sf):
    """FT-17: remaining-life target from wear and wear rate."""
    return _feats(spark, sf).select(*KEY_OUT, "tool_wear_rate", "rul_target", "rul_estimate_hours")


SENSOR_KEYS = ["id", "machine_id", "station_id", "timestamp"]
SENSOR_KEYS_SQL = 'id, machine_id, station_id, "timestamp"'


@register("rolling_mean", sql=f"""
SELECT {SENSOR_KEYS_SQL}, round(avg(vibration_rms) OVER ({SENSOR_WIN} {TRAIL}), 6) AS rolling_mean
FROM sensor_readings
""")
def q_rolling_mean(spark, sf):
    """FT-18 / WN-3: mean of the 12 previous readings per machine (current row excluded)."""
    out = ft.history(t.sensor(spark, sf), ["machine_id", "station_id"], ["timestamp", "id"], 12,
                     means={"rolling_mean": "vibration_rms"})
    return out.select(*SENSOR_KEYS, "rolling_mean")


@register("rolling_std", sql=f"""
SELECT {SENSOR_KEYS_SQL}, round(stddev_samp(process_temperature) OVER ({SENSOR_WIN} {TRAIL}), 6) AS rolling_std
FROM sensor_readings
""")
def q_rolling_std(spark, sf):
    """FT-18 / WN-3: sample std of the 12 previous readings per machine."""
    out = ft.history(t.sensor(spark, sf), ["machine_id", "station_id"], ["timestamp", "id"], 12,
                     stds={"rolling_std": "process_temperature"})
    return out.select(*SENSOR_KEYS, "rolling_std")


@register("wear_rate", sql=f"""
SELECT {SENSOR_KEYS_SQL}, round({_rate.format(w=SENSOR_WIN)}, 6) AS wear_rate
FROM sensor_readings
""")
def q_wear_rate(spark, sf):
    """FT-18 / WN-1: tool-wear change per hour against the previous reading."""
    out = ft.history(t.sensor(spark, sf), ["machine_id", "station_id"], ["timestamp", "id"], 1,
                     rates={"wear_rate": "tool_wear"})
    return out.select(*SENSOR_KEYS, "wear_rate")


@register("processed_dataset", sql=f"""
SELECT {_keys_sql()}, round(tool_wear_rate, 6) AS tool_wear_rate,
       round(equipment_process_risk_index, 6) AS equipment_process_risk_index, failure_label
FROM feat
""", extra_ctes=ASOF_CTES + "," + ROW_FEATURES)
def q_processed_dataset(spark, sf):
    """SRC-8: features written as a line-partitioned Parquet table and read back."""
    from ..session import scratch_path
    from ..sources import sinks

    path = scratch_path(spark, "processed")
    sinks.write_processed(_feats(spark, sf), path)
    back = sinks.read_processed(spark, path)
    return back.select(*KEY_OUT, "tool_wear_rate", "equipment_process_risk_index", "failure_label")
