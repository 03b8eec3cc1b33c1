"""The flagship query and its SQL, with the scoring rules written out a second time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, quality, scoring
from . import tables as t
from .catalog import register
from .queries_core import joined
from .queries_features import ROW_FEATURES
from .queries_quality import _flat_sql
from .queries_readmodels import _round2
from .sqlfrag import ASOF_CTES, clip01

# Weights, thresholds and texts of the source system's rules, stated here independently of
# ``operators.scoring`` so that a wrong value there shows.
_CTES = ASOF_CTES + "," + ROW_FEATURES + f""",
flat AS ({_flat_sql()}),
inputs AS (
  SELECT feat.*, coalesce(flat.flatline_sensor_flag, 0) AS flag FROM feat LEFT JOIN flat ON feat.id = flat.id
),
risk AS (
  SELECT *, {clip01(
      "0.34 * " + clip01("coalesce(equipment_process_risk_index, 0.0)")
      + " + 0.16 * " + clip01("coalesce(tool_wear, 0.0) / 100.0")
      + " + 0.14 * " + clip01("(1.0 - coalesce(process_stability_index, 1.0)) + abs(coalesce(temperature_delta, 0.0)) / 80.0")
      + " + 0.08 * " + clip01("CAST(flag AS DOUBLE)")
      + " + 0.08 * (CASE WHEN rul_target IS NULL THEN 0.0 WHEN rul_target <= 24.0 THEN 1.0 WHEN rul_target >= 168.0 THEN 0.0"
      + " ELSE (168.0 - rul_target) / 144.0 END)")} AS combined
  FROM inputs
),
health AS (SELECT *, {_round2("100.0 * (1.0 - combined)")} AS health_score FROM risk)
"""


@register("machine_health", sql="""
SELECT id_prod, machine_id, line_id, station_id, "timestamp",
       round(equipment_process_risk_index, 6) AS equipment_process_risk_index, round(rul_target, 6) AS rul_estimate_hours, health_score,
       CASE WHEN health_score >= 85.0 THEN 'low' WHEN health_score >= 70.0 THEN 'medium' WHEN health_score >= 50.0 THEN 'high'
            ELSE 'critical' END AS risk_level,
       CASE WHEN flag <> 0 THEN 'Flatline sensor pattern detected. This may indicate a stuck sensor, not a healthy machine.'
            WHEN coalesce(vibration_rms, 0.0) >= 3.5 AND coalesce(motor_current, 0.0) >= 9.0 AND 0.0 >= 0.01
            THEN 'High vibration plus high motor current and yield drop suggests possible bearing wear, imbalance, or mechanical friction.'
            WHEN coalesce(process_temperature, 0.0) >= 80.0 AND coalesce(process_stability_index, 1.0) <= 0.70
            THEN 'High process temperature with low process stability suggests possible thermal process drift.'
            WHEN coalesce(torque, 0.0) >= 35.0 AND coalesce(tool_wear, 0.0) >= 70.0
            THEN 'High torque with high tool wear suggests possible tool wear, overload, or increased mechanical resistance.'
            WHEN coalesce(equipment_process_risk_index >= 0.80, false)
            THEN 'Model indicates high failure probability based on combined equipment and process risk.'
            ELSE 'No dominant rule-based fault signature detected. Continue monitoring trend and model outputs.' END AS diagnostic_hint
FROM health
""", extra_ctes=_CTES)
def q_machine_health(spark, sf):
    """Flagship: as-of join -> history features -> health score and hint per event."""
    feats = features.add_engineered_features(quality.with_flatline(joined(spark, sf), t.sensor(spark, sf)))
    scored = scoring.score(feats.withColumn("failure_probability", F.col("equipment_process_risk_index"))
                           .withColumn("anomaly_score", F.lit(None).cast("double")))
    return scored.select("id_prod", "machine_id", "line_id", "station_id", "timestamp",
                         "equipment_process_risk_index", "rul_estimate_hours", "health_score", "risk_level",
                         "diagnostic_hint")
