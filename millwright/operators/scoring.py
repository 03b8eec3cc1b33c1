"""Health score, risk bands, diagnostic hints and alert rule (SC-1..4, SC-7, SC-8).

All column expressions: the whole scoring step is one projection inside a
single whole-stage-codegen span.  Missing inputs (null or absent column) take
the documented default; a stored 0.0 is kept as 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import clamp01

# Risk weights of the health score.
HEALTH_WEIGHTS = {"failure_probability": 0.34, "anomaly_risk": 0.20, "tool_wear_index": 0.16,
                  "process_drift_score": 0.14, "data_quality_penalty": 0.08, "rul_penalty": 0.08}

# Machine risk bands (health >= 85 / 70 / 50) and their actions.
RISK_BANDS = [
    (85.0, "low", "Continue normal monitoring."),
    (70.0, "medium", "Review trend and schedule inspection if degradation continues."),
    (50.0, "high", "Plan maintenance inspection and check recent process changes."),
    (None, "critical", "Escalate for immediate engineering review and possible controlled stop."),
]

# Diagnostic hint texts, in rule order (first match wins).
HINT_FLATLINE = (
    "Flatline sensor pattern detected. This may indicate a stuck sensor, not a healthy machine.",
    "Check sensor wiring, PLC tag mapping, and acquisition logs before trusting the signal.")
HINT_BEARING = (
    "High vibration plus high motor current and yield drop suggests possible bearing wear, imbalance, or mechanical friction.",
    "Inspect bearing condition, alignment, spindle balance, and recent reject trend.")
HINT_THERMAL = (
    "High process temperature with low process stability suggests possible thermal process drift.",
    "Review temperature control loop, cooling, recipe limits, and thermal chamber calibration.")
HINT_TOOL = (
    "High torque with high tool wear suggests possible tool wear, overload, or increased mechanical resistance.",
    "Inspect tooling, lubrication, material feed, and load profile.")
HINT_MODEL = (
    "Model indicates high failure probability based on combined equipment and process risk.",
    "Escalate to maintenance engineering and compare with recent maintenance history.")
HINT_ANOMALY = (
    "Process anomaly detector found a strong deviation from learned normal operating patterns.",
    "Check recent process changes, raw material lots, sensor quality, and station setup.")
HINT_DEFAULT = (
    "No dominant rule-based fault signature detected. Continue monitoring trend and model outputs.",
    "Monitor dashboard, review health score trend, and verify data quality.")

TRAINING_ALERT_MESSAGE = "IsolationForest process anomaly detected in simulated manufacturing data."


def _num(df: DataFrame, name: str, default: float) -> Column:
    """Present column with null -> default; absent column -> default."""
    if name in df.columns:
        return F.coalesce(F.col(name).cast("double"), F.lit(float(default)))
    return F.lit(float(default))


def feature_based_scores(df: DataFrame) -> DataFrame:
    """SC-1: wear index, process drift, data-quality penalty."""
    stability = _num(df, "process_stability_index", 1.0)
    return df.withColumns({
        "tool_wear_index": clamp01(_num(df, "tool_wear", 0.0) / 100.0),
        "process_drift_score": clamp01((1.0 - stability) + F.abs(_num(df, "temperature_delta", 0.0)) / 80.0),
        "data_quality_penalty": clamp01(_num(df, "flatline_sensor_flag", 0.0)),
    })


def rul_penalty(rul: Column) -> Column:
    """SC-3: <=24 h -> 1, >=168 h -> 0, linear between; null -> 0."""
    return (F.when(rul.isNull(), F.lit(0.0))
             .when(rul <= 24.0, F.lit(1.0))
             .when(rul >= 168.0, F.lit(0.0))
             .otherwise(clamp01((168.0 - rul) / 144.0)))


def anomaly_risk(score: Column) -> Column:
    return F.when(score.isNull(), F.lit(0.0)).otherwise(clamp01(-score / 0.30))


def risk_level_of(health: Column) -> Column:
    expr = None
    for lo, level, _ in RISK_BANDS:
        if lo is None:
            expr = expr.otherwise(F.lit(level))
        else:
            expr = (F.when(health >= lo, F.lit(level)) if expr is None
                    else expr.when(health >= lo, F.lit(level)))
    return expr


def action_of(level: Column) -> Column:
    expr = F
    for _, lvl, action in RISK_BANDS:
        expr = expr.when(level == lvl, F.lit(action))
    return expr


def health_score(df: DataFrame) -> DataFrame:
    """SC-2: components, combined risk, health (2 decimals), band and action."""
    w = HEALTH_WEIGHTS
    comps = {
        "c_failure_probability": clamp01(_num(df, "failure_probability", 0.0)),
        "c_anomaly_risk": anomaly_risk(F.col("anomaly_score").cast("double")
                                       if "anomaly_score" in df.columns else F.lit(None).cast("double")),
        "c_tool_wear_index": clamp01(_num(df, "tool_wear_index", 0.0)),
        "c_process_drift_score": clamp01(_num(df, "process_drift_score", 0.0)),
        "c_data_quality_penalty": clamp01(_num(df, "data_quality_penalty", 0.0)),
        "c_rul_penalty": rul_penalty(F.col("rul_estimate_hours").cast("double")
                                     if "rul_estimate_hours" in df.columns else F.lit(None).cast("double")),
    }
    out = df.withColumns(comps)
    risk = clamp01(sum(w[k[2:]] * F.col(k) for k in comps))
    out = out.withColumn("combined_risk", risk)
    out = out.withColumn("health_score", F.round(100.0 * (1.0 - F.col("combined_risk")), 2))
    out = out.withColumn("risk_level", risk_level_of(F.col("health_score")))
    out = out.withColumn("recommended_action", action_of(F.col("risk_level")))
    return out.withColumn("risk_components", F.struct(
        *[F.col(k).alias(k[2:]) for k in comps], F.col("combined_risk"))).drop(*comps)


def diagnostic_hint(df: DataFrame) -> DataFrame:
    """SC-4: ordered rule table, first match wins -> (diagnostic_hint, hint_action)."""
    def v(name, default):
        return _num(df, name, default)

    flat = (F.coalesce(F.col("flatline_sensor_flag").cast("double"), F.lit(0.0)) != 0
            if "flatline_sensor_flag" in df.columns else F.lit(False))
    fp = F.col("failure_probability").cast("double") if "failure_probability" in df.columns else F.lit(None)
    an = F.col("anomaly_score").cast("double") if "anomaly_score" in df.columns else F.lit(None)
    rules = [
        (flat, HINT_FLATLINE),
        ((v("vibration_rms", 0) >= 3.5) & (v("motor_current", 0) >= 9.0) & (v("yield_drop_rate", 0) >= 0.01),
         HINT_BEARING),
        ((v("process_temperature", 0) >= 80.0) & (v("process_stability_index", 1.0) <= 0.70), HINT_THERMAL),
        ((v("torque", 0) >= 35.0) & (v("tool_wear", 0) >= 70.0), HINT_TOOL),
        (F.coalesce(fp >= 0.80, F.lit(False)), HINT_MODEL),
        (F.coalesce(an < -0.15, F.lit(False)), HINT_ANOMALY),
    ]
    hint, act = F, F
    for cond, (h, a) in rules:
        hint = hint.when(cond, F.lit(h))
        act = act.when(cond, F.lit(a))
    return df.withColumns({"diagnostic_hint": hint.otherwise(F.lit(HINT_DEFAULT[0])),
                           "hint_action": act.otherwise(F.lit(HINT_DEFAULT[1]))})


def score(df: DataFrame) -> DataFrame:
    """SC-1 -> SC-2 -> SC-4 in one projection chain."""
    return diagnostic_hint(health_score(feature_based_scores(df)))


def alerts(scored: DataFrame, source: str = "batch_scoring") -> DataFrame:
    """SC-7: risk high/critical or anomaly flag -> alert with severity = risk level."""
    flag = F.coalesce(F.col("anomaly_flag").cast("int"), F.lit(0)) == 1
    # the band test on the score it is cut from: the filter doesn't repeat the nested bands
    return scored.where((F.col("health_score") < RISK_BANDS[1][0]) | flag).select(
        *[c for c in ["id"] if c in scored.columns],
        "machine_id", "line_id", "station_id", "timestamp", "anomaly_score",
        F.col("risk_level").alias("severity"),
        F.col("diagnostic_hint").alias("message"),
        F.lit(source).alias("source"))


def training_alerts(scored: DataFrame, limit: int = 100) -> DataFrame:
    """SC-8: the most anomalous flagged rows (ascending score, top ``limit``)."""
    top = (scored.where(F.col("anomaly_flag") == 1)
           .orderBy(F.col("anomaly_score").asc_nulls_last(), F.col("id").asc()).limit(limit))
    return top.select(
        "id", "machine_id", "line_id", "station_id", "timestamp", "anomaly_score",
        F.when(F.col("anomaly_score") < -0.15, F.lit("high")).otherwise(F.lit("medium")).alias("severity"),
        F.lit(TRAINING_ALERT_MESSAGE).alias("message"),
        F.lit("training_pipeline").alias("source"))
