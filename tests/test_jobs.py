"""End-to-end smoke: build dataset, train three models, persist bundles, score with them."""
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from millwright.ml import iforest, train as tr
from millwright.operators import asof, features as ft
from millwright.operators.predict import score_with_models
from millwright.plans import jobs
from millwright.sources import fixtures


def test_train_all_and_score(spark):
    out = tempfile.mkdtemp(prefix="mw-job-")
    s, p = fixtures.sensor_readings(spark, SF001), fixtures.production_events(spark, SF001)
    summary = jobs.train_all(spark, s, p, out, tolerance_seconds=21600, num_trees=5, gbt_iter=5)
    assert summary["rows"] > 50 and summary["flagged"] >= 1
    reg = spark.read.parquet(f"{out}/model_registry").collect()
    assert {r["model_name"] for r in reg} == {"failure_model", "rul_model", "anomaly_model"}
    rows = {r["model_name"]: (r["training_rows"], r["test_rows"]) for r in reg}
    assert rows["anomaly_model"] == (summary["rows"], 0)
    assert all(0 < rows[m][1] < rows[m][0] and sum(rows[m]) <= summary["rows"] for m in ("failure_model", "rul_model"))
    assert spark.read.parquet(f"{out}/alerts").count() == min(100, summary["flagged"])
    assert all('"vibration_rms"' in r["feature_columns_json"] for r in reg)
    fmodel, fmeta = tr.load_bundle(spark, f"{out}/models/failure")
    rmodel, _ = tr.load_bundle(spark, f"{out}/models/rul")
    data = spark.read.parquet(f"{out}/processed")
    forest, ameta = iforest.load_bundle(spark, f"{out}/models/anomaly")
    again, refit = iforest.fit(data, [c for c in ameta["feature_columns"]], id_col="id_prod")
    assert again.offset == forest.offset
    assert forest.flag(forest.score(data)).where("anomaly_flag = 1").count() == refit.where("anomaly_flag = 1").count()
    scored = score_with_models(data, fmodel, rmodel, forest, fmeta["feature_columns"], fmeta["fill_values"])
    row = scored.where(F.col("health_score").isNotNull()).first()
    assert 0.0 <= row["failure_probability"] <= 1.0 and row["rul_estimate_hours"] >= 0.0
    assert row["risk_level"] in {"low", "medium", "high", "critical"} and row["diagnostic_hint"]


def test_one_class_is_an_error(spark):
    import pytest

    data = spark.createDataFrame([(i, 1, 0.0) for i in range(50)], "id long, failure_label int, tool_wear double")
    data = data.withColumn("timestamp", F.timestamp_seconds(F.col("id") * 60)).withColumn("equipment_process_risk_index", F.lit(0.3))
    with pytest.raises(tr.OneClassError):
        tr.train_failure(data, num_trees=2, gbt_iter=2)


def test_load_bundle_missing_raises(spark):
    import pytest

    with pytest.raises(tr.ModelNotTrainedError):
        tr.load_bundle(spark, tempfile.mkdtemp(prefix="mw-empty-"))
    with pytest.raises(tr.ModelNotTrainedError):
        iforest.load_bundle(spark, tempfile.mkdtemp(prefix="mw-empty-"))


def test_single_payload_inference_defaults(spark):
    payload = spark.createDataFrame([("M1", "L1", "S1", 1.5, 35.0)],
                                    "machine_id string, line_id string, station_id string, vibration_rms double, "
                                    "tool_wear double")
    out = ft.add_engineered_features(ft.prepare_inference(payload.withColumn("id", F.lit(1))))
    r = out.first()
    assert r["target_throughput"] == 1 and r["process_stability_index"] == 1.0
    assert r["event_timestamp"] is not None and r["rolling_vibration_mean"] == 1.5
    assert asof is not None


def test_payloads_need_no_id_and_are_not_one_anothers_history(spark):
    rows = [("M1", "L1", "S1", 1.5, 35.0), ("M1", "L1", "S1", 2.5, 90.0)]
    schema = "machine_id string, line_id string, station_id string, vibration_rms double, tool_wear double"
    payload = ft.prepare_inference(spark.createDataFrame(rows, schema))
    got = ft.payload_features(payload)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    got = {r["vibration_rms"]: r for r in got.collect()}
    one = ft.add_engineered_features(payload.where("vibration_rms = 2.5").withColumn("id", F.lit(1))).first().asDict()
    assert {k: v for k, v in got[2.5].asDict().items() if k != "timestamp" and "timestamp" not in k} == {
        k: v for k, v in one.items() if "timestamp" not in k and k != "id"}
