"""Features are history-only; scoring bands, penalties, hints and clip semantics."""
import pytest
from pyspark.sql import functions as F

from conftest import ts
from millwright import schemas as S
from millwright.functions.coerce import clip01
from millwright.operators import features as ft
from millwright.operators import readmodels as rm
from millwright.operators import scoring as sc


def test_rolling_mean_is_historical(spark):
    df = spark.createDataFrame([(1, "M1", "S1", "L1", ts(0), 1.0), (2, "M1", "S1", "L1", ts(1), 2.0),
                                (3, "M1", "S1", "L1", ts(2), 100.0)],
                               "id long, machine_id string, station_id string, line_id string, timestamp timestamp, vibration_rms double")
    out = ft.history(df, ["machine_id", "station_id"], ["timestamp", "id"], 2, means={"m": "vibration_rms"})
    got = {r["id"]: r["m"] for r in out.collect()}
    assert got == {1: None, 2: 1.0, 3: 1.5}
    full = {r["id"]: r["rolling_vibration_mean"] for r in ft.add_engineered_features(df, rolling_window=2).collect()}
    assert full[1] == 1.0 and full[2] == 1.0 and full[3] == 1.5


def test_identity_only_rows_have_no_infinities(spark):
    df = spark.createDataFrame([(1, "M", "L", "S", ts(0))], "id long, machine_id string, line_id string, station_id string, timestamp timestamp")
    row = ft.add_engineered_features(df).collect()[0].asDict()
    for c in S.FEATURE_COLUMNS:
        v = row[c]
        assert v is None or abs(v) != float("inf"), c


def test_leakage_guard_and_disjoint_lists():
    with pytest.raises(ValueError):
        S.assert_no_leakage(["vibration_rms", "failure_label"])
    assert not set(S.FEATURE_COLUMNS) & set(S.TARGET_COLUMNS + S.SYNTHETIC_LABEL_COLUMNS)
    assert "hidden_degradation_state" not in S.FEATURE_COLUMNS
    assert S.leakage_warnings(["future_x", "torque"]) == {"future_x": ["future"]}


def test_clip_keeps_null(spark):
    r = spark.range(1).select(clip01(F.lit(None).cast("double")).alias("a"), clip01(F.lit(3.0)).alias("b")).first()
    assert r["a"] is None and r["b"] == 1.0


@pytest.mark.parametrize("rul,pen", [(None, 0.0), (24.0, 1.0), (96.0, 0.5), (168.0, 0.0), (500.0, 0.0)])
def test_rul_penalty(spark, rul, pen):
    v = spark.range(1).select(sc.rul_penalty(F.lit(rul).cast("double")).alias("p")).first()["p"]
    assert v == pytest.approx(pen)


def test_health_bands_and_defaults(spark):
    df = spark.createDataFrame([(1, 0.0, None, 0.0, 1.0, 0.0), (2, 1.0, -0.9, 100.0, 0.0, 50.0)],
                               "id long, failure_probability double, anomaly_score double, tool_wear double, "
                               "process_stability_index double, temperature_delta double")
    out = {r["id"]: r for r in sc.score(df).collect()}
    assert out[1]["health_score"] == 100.0 and out[1]["risk_level"] == "low"
    assert out[2]["risk_level"] == "critical"
    # a stored stability of 0.0 is a real value, not "missing" (drift saturates)
    assert out[2]["risk_components"]["process_drift_score"] == 1.0


@pytest.mark.parametrize("h,level", [(85.0, "low"), (84.99, "medium"), (70.0, "medium"), (50.0, "high"), (49.99, "critical")])
def test_machine_bands(spark, h, level):
    assert spark.range(1).select(sc.risk_level_of(F.lit(h)).alias("l")).first()["l"] == level


@pytest.mark.parametrize("h,level", [(None, "unknown"), (80.0, "low"), (60.0, "medium"), (40.0, "high"), (39.9, "critical")])
def test_line_bands(spark, h, level):
    assert spark.range(1).select(rm.risk_band_line(F.lit(h).cast("double")).alias("l")).first()["l"] == level


def test_hint_rule_order(spark):
    rows = [(1, 1.0, 4.0, 10.0, 0.02, 90.0, 0.5, 40.0, 80.0, 0.9, -0.9),
            (2, 0.0, 4.0, 10.0, 0.02, 90.0, 0.5, 40.0, 80.0, 0.9, -0.9),
            (3, 0.0, 0.0, 0.0, 0.0, 90.0, 0.5, 40.0, 80.0, 0.9, -0.9),
            (4, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 40.0, 80.0, 0.9, -0.9),
            (5, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.9, -0.9),
            (6, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.1, -0.9),
            (7, 0.0, 0.0, 0.0, 0.0, 0.0, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, flatline_sensor_flag double, vibration_rms double, motor_current double, "
                               "yield_drop_rate double, process_temperature double, process_stability_index double, "
                               "torque double, tool_wear double, failure_probability double, anomaly_score double")
    got = {r["id"]: r["diagnostic_hint"] for r in sc.diagnostic_hint(df).collect()}
    expect = [sc.HINT_FLATLINE, sc.HINT_BEARING, sc.HINT_THERMAL, sc.HINT_TOOL, sc.HINT_MODEL, sc.HINT_ANOMALY,
              sc.HINT_DEFAULT]
    assert [got[i] for i in range(1, 8)] == [h for h, _ in expect]


def test_action_queue_fallback_row(spark):
    empty_pred = spark.createDataFrame([], "machine_id string, line_id string, station_id string, timestamp timestamp, "
                                           "risk_level string, health_score double, recommended_action string")
    empty_alerts = spark.createDataFrame([], "id long, machine_id string, line_id string, station_id string, "
                                             "severity string, anomaly_score double, message string")
    empty_issues = spark.createDataFrame([], "entity_id string, machine_id string, line_id string, station_id string, "
                                             "timestamp timestamp, severity string, issue_type string")
    got = rm.action_queue(empty_pred, empty_alerts, empty_issues).collect()
    assert [r["priority"] for r in got] == ["Monitor"]


@pytest.mark.parametrize("secs,text", [(59, "59s ago"), (60, "1m ago"), (3599, "59m ago"), (47 * 3600, "47h ago"),
                                       (48 * 3600, "2d ago"), (-5, "0s ago"), (None, "N/A")])
def test_age_text(spark, secs, text):
    from millwright.functions.timefn import age_text

    now = ts(0)
    when = None if secs is None else now - __import__("datetime").timedelta(seconds=secs)
    df = spark.createDataFrame([(when, now)], "t timestamp, now timestamp")
    assert df.select(age_text(F.col("t"), F.col("now")).alias("a")).first()["a"] == text
