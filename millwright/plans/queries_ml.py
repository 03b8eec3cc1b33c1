"""Registered ML queries: statistics and metrics (SQL oracles) and trainers (rows only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..ml import metrics as mt
from ..ml import split as sp
from ..ml import stats as st
from . import tables as t
from .catalog import register
from .queries_features import ROW_FEATURES, _feats
from .sqlfrag import ASOF_CTES

FEAT_CTES = ASOF_CTES + "," + ROW_FEATURES


@register("risk_quantiles", sql="""
SELECT q, round(value, 6) AS value FROM (
  SELECT 0.5::DOUBLE AS q, quantile_cont(equipment_process_risk_index, 0.5) AS value FROM risk_f
  UNION ALL SELECT 0.75::DOUBLE, quantile_cont(equipment_process_risk_index, 0.75) FROM risk_f
  UNION ALL SELECT 0.85::DOUBLE, quantile_cont(equipment_process_risk_index, 0.85) FROM risk_f)
""", extra_ctes=FEAT_CTES)
def q_risk_quantiles(spark, sf):
    """AG-11: exact interpolated quantiles .5/.75/.85 of the risk index."""
    from ..operators import features as ft
    from .queries_core import joined

    risk = ft.risk_index(ft.row_features(ft.prepare(joined(spark, sf))))
    return st.exact_quantiles(risk, "equipment_process_risk_index", [0.5, 0.75, 0.85])


@register("time_split", sql="""
SELECT id, "timestamp", CAST(rn - 1 < greatest(1, CAST(floor(n * 0.8) AS BIGINT)) AS INTEGER) AS is_train,
       rn - 1 AS split_position
FROM (SELECT id, "timestamp", row_number() OVER (ORDER BY "timestamp", id) AS rn, count(*) OVER () AS n
      FROM sensor_readings WHERE "timestamp" IS NOT NULL)
""")
def q_time_split(spark, sf):
    """ML-1: first 80 % of readings by (timestamp, id) are training rows."""
    s = sp.with_split(t.sensor(spark, sf), 0.2)
    return s.select("id", "timestamp", F.col("is_train").cast("int").alias("is_train"), "split_position")


@register("class_weights", sql="""
SELECT failure_label, count(*) AS class_count,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM feat WHERE failure_label IS NOT NULL GROUP BY failure_label
""", extra_ctes=FEAT_CTES)
def q_class_weights(spark, sf):
    """ML-6 / AG-12: balanced class weights n / (k n_c)."""
    return st.class_weights(_feats(spark, sf), "failure_label")


_IMPUTE_COLS = ["air_temperature", "process_temperature", "vibration_rms", "vibration_peak", "pressure"]


@register("median_impute", sql="SELECT id, " + ", ".join(
    f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM sensor_readings)), 6) AS {c}"
    for c in _IMPUTE_COLS) + " FROM sensor_readings")
def q_median_impute(spark, sf):
    """ML-4: nulls replaced by each column's exact median."""
    s = t.sensor(spark, sf)
    return st.median_impute(s, _IMPUTE_COLS).select("id", *_IMPUTE_COLS)


_CM_CTES = """
base AS (SELECT CAST(failure_label AS INTEGER) AS y, equipment_process_risk_index AS p FROM feat
         WHERE failure_label IS NOT NULL AND equipment_process_risk_index IS NOT NULL),
conf AS (SELECT count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
                count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn
         FROM base),
sc AS (SELECT p AS s, count(*) AS ns, sum(y) AS ps FROM base GROUP BY 1),
rk AS (SELECT *, coalesce(sum(ns) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
              sum(ps) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctp,
              sum(ns) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn FROM sc),
cv AS (SELECT sum(ps * (bef + (ns + 1) / 2.0)) AS rank_sum, sum(ctp / cn * ps) AS ap_sum,
              sum(ps) AS P, sum(ns) AS n FROM rk)
"""


@register("classification_metrics", sql="""
SELECT 0.5::DOUBLE AS threshold, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
       round(CASE WHEN tp > 0
             THEN 2.0 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn)))
             ELSE 0.0 END, 6) AS f1,
       tn, fp, fn, tp, fn AS false_negative_count,
       round(CASE WHEN P > 0 AND n - P > 0 THEN (rank_sum - P * (P + 1) / 2.0) / (P * (n - P)) END, 6) AS roc_auc,
       round(CASE WHEN P > 0 AND n - P > 0 THEN ap_sum / P END, 6) AS pr_auc
FROM conf, cv
""", extra_ctes=FEAT_CTES + "," + _CM_CTES)
def q_classification_metrics(spark, sf):
    """ML-13: threshold metrics, ROC-AUC and average precision of risk vs future failure."""
    return mt.classification_metrics(_feats(spark, sf), "failure_label", "equipment_process_risk_index")


@register("regression_metrics", sql="""
SELECT round(avg(abs(y - yh)), 6) AS mae, round(sqrt(avg((y - yh) * (y - yh))), 6) AS rmse,
       round(CASE WHEN var_pop(y) * count(*) > 0
             THEN 1.0 - sum((y - yh) * (y - yh)) / (var_pop(y) * count(*)) END, 6) AS r2
FROM (SELECT rul_target AS y, least(5000.0, greatest(0.0, 100.0 - tool_wear) * 18.0) AS yh FROM feat
      WHERE rul_target IS NOT NULL AND tool_wear IS NOT NULL)
""", extra_ctes=FEAT_CTES)
def q_regression_metrics(spark, sf):
    """ML-14: MAE, RMSE, R^2 of the wear-only RUL heuristic against the RUL target."""
    f = _feats(spark, sf).withColumn(
        "rul_heuristic", F.least(F.lit(5000.0), F.greatest(F.lit(0.0), 100.0 - F.col("tool_wear")) * 18.0))
    return mt.regression_metrics(f, "rul_target", "rul_heuristic")


@register("anomaly_metrics", sql="""
SELECT CAST(sum(coalesce(anomaly_flag, 0)) AS BIGINT) AS anomaly_count, count(*) AS row_count,
       round(coalesce(avg(anomaly_flag), 0.0), 6) AS anomaly_rate, round(min(anomaly_score), 6) AS score_min,
       round(avg(anomaly_score), 6) AS score_mean, round(max(anomaly_score), 6) AS score_max
FROM predictions
""")
def q_anomaly_metrics(spark, sf):
    """ML-15: anomaly count, rate and score range."""
    return mt.anomaly_metrics(t.predictions(spark, sf))


# ----------------------------------------------------------------------- trainers (rows-only check)
def _feature_table(spark, sf):
    from ..session import materialize

    return materialize(_feats(spark, sf), "features")


@register("train_failure")
def q_train_failure(spark, sf):
    """ML-1..10: failure classifiers (LR, RF 80 trees, GBT 100 rounds); one metrics row per candidate."""
    from ..ml import train as tr

    res = tr.train_failure(_feature_table(spark, sf))
    return res.candidates.select("model_name", "selected", "accuracy", "precision", "recall", "f1",
                                 "roc_auc", "pr_auc", "tp", "fp", "tn", "fn")


@register("train_rul")
def q_train_rul(spark, sf):
    """ML-11: RUL regressors (RF, GBT); one metrics row per candidate."""
    from ..ml import train as tr

    res = tr.train_rul(_feature_table(spark, sf))
    return res.candidates.select("model_name", "selected", "mae", "rmse", "r2")


@register("isolation_forest")
def q_isolation_forest(spark, sf):
    """ML-12: isolation forest (100 trees, 256 samples, 4 % contamination) over all feature rows."""
    from .. import schemas as S
    from ..ml import iforest

    feats = _feature_table(spark, sf)
    cols = [c for c in S.FEATURE_COLUMNS if c in feats.columns]
    _model, scored = iforest.fit(feats, cols, id_col="id_prod")
    return scored.select("id_prod", "machine_id", "timestamp", "anomaly_score", "anomaly_flag")


@register("feature_importances")
def q_feature_importances(spark, sf):
    """ML-18 / SO-5: top 25 feature importances of the failure random forest."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier

    from ..ml import train as tr

    feats = _feature_table(spark, sf)
    cols = tr.feature_columns(feats)
    fills = st.medians(feats, cols)
    data = feats.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fills.get(c, 0.0))) for c in cols})
    model = Pipeline(stages=[tr._assembled(cols), RandomForestClassifier(
        labelCol="failure_label", numTrees=80, minInstancesPerNode=2, maxDepth=tr.FOREST_MAX_DEPTH,
        seed=42)]).fit(data)
    res = tr.TrainResult(spark.createDataFrame([("rf", True)], "model_name string, selected boolean"), "rf", model,
                         cols, fills)
    return tr.feature_importances(res, 25)


@register("class_distribution", sql="""
SELECT failure_label, class_count, round(share, 6) AS share, round(weight, 6) AS weight,
       min(share) OVER () < 0.25 AS balanced
FROM (SELECT failure_label, class_count, class_count / sum(class_count) OVER () AS share,
             sum(class_count) OVER () / (count(*) OVER () * class_count) AS weight
      FROM (SELECT failure_label, count(*) AS class_count FROM feat WHERE failure_label IS NOT NULL
            GROUP BY failure_label))
""", extra_ctes=FEAT_CTES)
def q_class_distribution(spark, sf):
    """AG-12: class counts, shares and whether balanced weights apply (minority share < .25)."""
    return st.class_distribution(_feats(spark, sf), "failure_label")


_SAVED: dict[tuple[str, str], str] = {}


def _trained(spark, sf) -> str:
    """All three models fitted on the feature rows with the job's defaults; the folder they are saved in.

    Bundles are saved to be used again: one fit for each application and data folder.
    """
    from ..session import scratch_path
    from . import jobs
    from .queries_core import ASOF_TOLERANCE_SECONDS

    key = spark.sparkContext.applicationId, sf
    if key not in _SAVED:
        root = scratch_path(spark, "trained")
        jobs.train_all(spark, t.sensor(spark, sf), t.production(spark, sf), root, ASOF_TOLERANCE_SECONDS)
        _SAVED[key] = root
    return _SAVED[key]


@register("train_registry", sql="""
SELECT model_name, training_rows, n - training_rows AS test_rows FROM (
  SELECT 'failure_model' AS model_name, greatest(1, CAST(floor(count(*) * 0.8) AS BIGINT)) AS training_rows, count(*) AS n
  FROM feat WHERE failure_label IS NOT NULL AND "timestamp" IS NOT NULL
  UNION ALL
  SELECT 'rul_model', greatest(1, CAST(floor(count(*) * 0.8) AS BIGINT)), count(*)
  FROM feat WHERE rul_target IS NOT NULL AND "timestamp" IS NOT NULL
  UNION ALL SELECT 'anomaly_model', count(*), count(*) FROM feat)
""", extra_ctes=FEAT_CTES)
def q_train_registry(spark, sf):
    """SRC-11/ML-16/ML-17: one registry row for each of the three models, with its split sizes."""
    return spark.read.parquet(f"{_trained(spark, sf)}/model_registry").select("model_name", "training_rows", "test_rows")


@register("scored_with_models", sql="""
SELECT id_prod, TRUE AS probability_ok, TRUE AS rul_ok, TRUE AS flag_ok, TRUE AS health_ok FROM joined
""", extra_ctes=ASOF_CTES)
def q_scored_with_models(spark, sf):
    """SC-6/ST-8: every joined event scored with the saved bundles; its outputs lie in their ranges."""
    from ..operators.predict import bundle_scorer

    root = _trained(spark, sf)
    scored = bundle_scorer(spark, f"{root}/models")(spark.read.parquet(f"{root}/processed"))
    return scored.select("id_prod", F.col("failure_probability").between(0.0, 1.0).alias("probability_ok"),
                         (F.col("rul_estimate_hours") >= 0).alias("rul_ok"),
                         (F.col("anomaly_flag").isin(0, 1) & (F.col("anomaly_score") < 0)).alias("flag_ok"),
                         F.col("health_score").between(0.0, 100.0).alias("health_ok"))
