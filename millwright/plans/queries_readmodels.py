"""Registered read-model queries (AG, SC-5, SC-9..12) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import readmodels as rm
from . import tables as t
from .catalog import register


@register("line_operational_summary", sql="""
SELECT line_id,
       count(*) AS production_event_count,
       round(avg(cycle_time_sec), 6) AS avg_cycle_time_sec,
       round(avg(station_yield), 6) AS avg_station_yield,
       round(sum(coalesce(downtime_minutes, 0)), 6) AS total_downtime_minutes,
       sum(coalesce(reject_count, 0))::BIGINT AS total_reject_count,
       max("timestamp") AS latest_production_timestamp
FROM production_events GROUP BY line_id
""")
def q_line_operational_summary(spark, sf):
    return rm.line_operational_summary(t.production(spark, sf))


# ======================================================================
# Scoring (SC-1..4, SC-7) over the prediction fixture
# ======================================================================
from ..operators import scoring as sc  # noqa: E402
from .queries_quality import ISSUES_CTE, issues  # noqa: E402
from .sqlfrag import clip01  # noqa: E402

AS_OF = "2024-01-31 00:00:00"  # time-relative read models take an explicit as-of (FIXTURES 3.5)


def _round2(expr):
    # Half-up rounding of the shortest decimal text of a double.
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE)"


def _band(h):
    return (f"CASE WHEN {h} >= 85 THEN 'low' WHEN {h} >= 70 THEN 'medium' "
            f"WHEN {h} >= 50 THEN 'high' ELSE 'critical' END")


def _action(level):
    return "CASE " + " ".join(f"WHEN {level} = '{lvl}' THEN '{a}'" for _, lvl, a in sc.RISK_BANDS) + " END"


_RISK = clip01(
    f"0.34 * {clip01('coalesce(failure_probability, 0.0)')}"
    f" + 0.20 * (CASE WHEN anomaly_score IS NULL THEN 0.0 ELSE {clip01('-anomaly_score / 0.30')} END)"
    f" + 0.16 * {clip01('coalesce(tool_wear_index, 0.0)')}"
    f" + 0.14 * {clip01('coalesce(process_drift_score, 0.0)')}"
    f" + 0.08 * {clip01('coalesce(data_quality_penalty, 0.0)')}"
    " + 0.08 * (CASE WHEN rul_estimate_hours IS NULL THEN 0.0 WHEN rul_estimate_hours <= 24.0 THEN 1.0"
    f" WHEN rul_estimate_hours >= 168.0 THEN 0.0 ELSE {clip01('(168.0 - rul_estimate_hours) / 144.0')} END)")


def _hint_case(field):
    idx = 0 if field == "hint" else 1
    rules = [
        ("coalesce(vibration_rms, 0.0) >= 3.5 AND coalesce(motor_current, 0.0) >= 9.0 AND 0.0 >= 0.01",
         sc.HINT_BEARING),
        ("coalesce(process_temperature, 0.0) >= 80.0 AND coalesce(process_stability_index, 1.0) <= 0.70",
         sc.HINT_THERMAL),
        ("coalesce(torque, 0.0) >= 35.0 AND coalesce(tool_wear, 0.0) >= 70.0", sc.HINT_TOOL),
        ("coalesce(failure_probability >= 0.80, false)", sc.HINT_MODEL),
        ("coalesce(anomaly_score < -0.15, false)", sc.HINT_ANOMALY),
    ]
    return ("CASE " + " ".join(f"WHEN {c} THEN '{t[idx]}'" for c, t in rules)
            + f" ELSE '{sc.HINT_DEFAULT[idx]}' END")


SCORED_CTES = f"""
fs AS (
  SELECT *, {clip01('coalesce(tool_wear, 0.0) / 100.0')} AS tool_wear_index,
         {clip01('(1.0 - coalesce(process_stability_index, 1.0)) + abs(coalesce(temperature_delta, 0.0)) / 80.0')}
           AS process_drift_score,
         0.0::DOUBLE AS data_quality_penalty
  FROM predictions
),
hs AS (SELECT *, {_RISK} AS combined_risk FROM fs),
hs2 AS (SELECT *, {_round2('100.0 * (1.0 - combined_risk)')} AS health_score FROM hs),
scored AS (
  SELECT *, {_band('health_score')} AS risk_level, {_action(_band('health_score'))} AS recommended_action,
         NULL::DOUBLE AS vibration_rms, NULL::DOUBLE AS motor_current, NULL::DOUBLE AS process_temperature,
         NULL::DOUBLE AS torque
  FROM hs2
),
scored_h AS (SELECT *, {_hint_case('hint')} AS diagnostic_hint, {_hint_case('action')} AS hint_action FROM scored),
alerts AS (
  SELECT id, machine_id, line_id, station_id, "timestamp", anomaly_score, risk_level AS severity,
         diagnostic_hint AS message, 'batch_scoring' AS source
  FROM scored_h WHERE risk_level IN ('high', 'critical') OR coalesce(anomaly_flag, 0) = 1
),
latest AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY machine_id
    ORDER BY "timestamp" DESC, id DESC) AS rn FROM scored_h
    WHERE machine_id IS NOT NULL AND "timestamp" IS NOT NULL) WHERE rn = 1
)
"""


def scored(spark, sf):
    return sc.score(t.predictions(spark, sf))


def alerts(spark, sf):
    return sc.alerts(scored(spark, sf))


def latest(spark, sf):
    return rm.latest_per_group(scored(spark, sf), ["machine_id"])


@register("feature_scores", sql="""
SELECT id, round(tool_wear_index, 6) AS tool_wear_index, round(process_drift_score, 6) AS process_drift_score,
       round(data_quality_penalty, 6) AS data_quality_penalty FROM fs
""", extra_ctes=SCORED_CTES)
def q_feature_scores(spark, sf):
    """SC-1: wear index, process drift and data-quality penalty per prediction row."""
    return sc.feature_based_scores(t.predictions(spark, sf)).select(
        "id", "tool_wear_index", "process_drift_score", "data_quality_penalty")


@register("health_score", sql="""
SELECT id, machine_id, round(combined_risk, 6) AS combined_risk, round(health_score, 6) AS health_score,
       risk_level, recommended_action FROM scored
""", extra_ctes=SCORED_CTES)
def q_health_score(spark, sf):
    """SC-2/3: combined risk, 0-100 health, band and recommended action."""
    return scored(spark, sf).select("id", "machine_id", "risk_components.combined_risk", "health_score",
                                    "risk_level", "recommended_action")


@register("diagnostic_hints", sql="""
SELECT id, diagnostic_hint, hint_action FROM scored_h
""", extra_ctes=SCORED_CTES)
def q_diagnostic_hints(spark, sf):
    """SC-4: first matching hint rule per prediction row."""
    return scored(spark, sf).select("id", "diagnostic_hint", "hint_action")


@register("alerts", sql="SELECT * FROM alerts", extra_ctes=SCORED_CTES)
def q_alerts(spark, sf):
    """SC-7: alert rows (high/critical risk or anomaly flag)."""
    return alerts(spark, sf)


# ======================================================================
# Read models
# ======================================================================
@register("acquisition_status", sql="""
SELECT (SELECT count(*) FROM sensor_readings) AS sensor_readings,
       (SELECT count(*) FROM production_events) AS production_events,
       (SELECT count(*) FROM issues) AS data_quality_issues,
       (SELECT max("timestamp") FROM sensor_readings) AS latest_sensor_timestamp,
       (SELECT max("timestamp") FROM production_events) AS latest_production_timestamp
""", extra_ctes=ISSUES_CTE)
def q_acquisition_status(spark, sf):
    """AG-1: table counts and latest timestamps in one row."""
    return rm.acquisition_status(t.sensor(spark, sf), t.production(spark, sf), issues(spark, sf))


@register("line_health", sql="""
SELECT l.line_id, coalesce(a.prediction_count, 0) AS prediction_count,
       round(a.avg_health_score, 6) AS avg_health_score,
       round(a.max_failure_probability, 6) AS max_failure_probability,
       round(a.min_rul_estimate_hours, 6) AS min_rul_estimate_hours,
       round(a.min_anomaly_score, 6) AS min_anomaly_score,
       coalesce(c.alert_count, 0) AS alert_count,
       CASE WHEN a.avg_health_score IS NULL THEN 'unknown' WHEN a.avg_health_score >= 80 THEN 'low'
            WHEN a.avg_health_score >= 60 THEN 'medium' WHEN a.avg_health_score >= 40 THEN 'high'
            ELSE 'critical' END AS risk_level
FROM (SELECT DISTINCT line_id FROM scored_h WHERE line_id IS NOT NULL
      UNION SELECT DISTINCT line_id FROM alerts WHERE line_id IS NOT NULL) l
LEFT JOIN (SELECT line_id, count(*) AS prediction_count, avg(health_score) AS avg_health_score,
                  max(failure_probability) AS max_failure_probability,
                  min(rul_estimate_hours) AS min_rul_estimate_hours, min(anomaly_score) AS min_anomaly_score
           FROM scored_h GROUP BY line_id) a ON l.line_id = a.line_id
LEFT JOIN (SELECT line_id, count(*) AS alert_count FROM alerts GROUP BY line_id) c ON l.line_id = c.line_id
""", extra_ctes=SCORED_CTES)
def q_line_health(spark, sf):
    """AG-3: every line's prediction aggregates, alert count and line risk band."""
    return rm.line_health(scored(spark, sf), alerts(spark, sf))


@register("executive_kpis", sql="""
SELECT (SELECT count(DISTINCT machine_id) FROM sensor_readings) AS total_machines,
       (SELECT count(DISTINCT line_id) FROM (SELECT line_id FROM sensor_readings
          UNION ALL SELECT line_id FROM production_events)) AS total_lines,
       (SELECT count(*) FILTER (WHERE risk_level IN ('high', 'critical')) FROM latest) AS critical_machines,
       (SELECT round(avg(health_score), 6) FROM latest) AS avg_health_score,
       (SELECT round(avg(rul_estimate_hours), 6) FROM latest) AS avg_rul_hours,
       CASE WHEN (SELECT count(*) FROM alerts) > 0 THEN (SELECT count(*) FROM alerts)
            ELSE (SELECT CAST(coalesce(sum(coalesce(anomaly_flag, 0)), 0) AS BIGINT) FROM scored_h) END AS anomaly_count
""", extra_ctes=SCORED_CTES)
def q_executive_kpis(spark, sf):
    """AG-4: machines, lines, high/critical machines, mean health and RUL, anomaly count."""
    return rm.executive_kpis(t.sensor(spark, sf), t.production(spark, sf), latest(spark, sf),
                             alerts(spark, sf), scored(spark, sf))


@register("line_health_summary", sql="""
SELECT line_id, count(DISTINCT machine_id) AS machines, round(avg(health_score), 6) AS avg_health_score,
       round(max(failure_probability), 6) AS max_failure_probability,
       round(min(rul_estimate_hours), 6) AS min_rul_hours
FROM latest GROUP BY line_id
""", extra_ctes=SCORED_CTES)
def q_line_health_summary(spark, sf):
    """AG-5: per line over each machine's latest prediction."""
    return rm.line_health_summary(latest(spark, sf))


@register("issue_counts", sql="""
SELECT issue_type, severity, count(*) AS issue_count FROM issues GROUP BY issue_type, severity
""", extra_ctes=ISSUES_CTE)
def q_issue_counts(spark, sf):
    """AG-6: issue counts by type and severity."""
    return rm.issue_counts(issues(spark, sf))


@register("ingest_per_minute", sql="""
SELECT date_trunc('minute', "timestamp") AS minute, stream_type, count(*) AS records
FROM (SELECT "timestamp", 'sensor' AS stream_type FROM sensor_readings
      UNION ALL SELECT "timestamp", 'production' AS stream_type FROM production_events)
WHERE "timestamp" IS NOT NULL GROUP BY 1, 2
""")
def q_ingest_per_minute(spark, sf):
    """AG-7: records per minute and stream."""
    return rm.ingest_per_minute(t.sensor(spark, sf), t.production(spark, sf))


@register("ingestion_kpis", sql="""
SELECT (SELECT max("timestamp") FROM (SELECT "timestamp" FROM sensor_readings
          UNION ALL SELECT "timestamp" FROM production_events)) AS last_received_timestamp,
       (SELECT count(*) FROM sensor_readings) + (SELECT count(*) FROM production_events)
         AS successful_ingestion_count,
       0::BIGINT AS failed_ingestion_count,
       (SELECT count(*) FROM issues WHERE issue_type = 'delayed_reading') AS delayed_readings,
       (SELECT count(*) FROM issues WHERE issue_type IN ('timestamp_gap', 'sensor_dropout'))
         AS buffered_records_proxy
""", extra_ctes=ISSUES_CTE)
def q_ingestion_kpis(spark, sf):
    """AG-8: last arrival, success/failed counts, delayed readings, buffered proxy."""
    return rm.ingestion_kpis(t.sensor(spark, sf), t.production(spark, sf), issues(spark, sf))


@register("freshness_state", sql=f"""
SELECT last_received_timestamp,
       round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_received_timestamp)) / 1e6, 6) AS age_seconds,
       CASE WHEN last_received_timestamp IS NULL THEN 'Waiting for data'
            WHEN (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_received_timestamp)) / 1e6 < 120
              THEN 'Live stream active'
            WHEN (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_received_timestamp)) / 1e6 < 3600
              THEN 'Stream delayed'
            ELSE 'Replay / offline dataset' END AS ingestion_state,
       CASE WHEN last_received_timestamp IS NULL
              OR (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_received_timestamp)) / 1e6 < 120
            THEN 'active' ELSE 'stale' END AS collector_status,
       CASE WHEN last_received_timestamp IS NULL THEN 'N/A'
            WHEN s < 60 THEN concat(CAST(s AS VARCHAR), 's ago')
            WHEN s // 60 < 60 THEN concat(CAST(s // 60 AS VARCHAR), 'm ago')
            WHEN s // 3600 < 48 THEN concat(CAST(s // 3600 AS VARCHAR), 'h ago')
            ELSE concat(CAST(s // 86400 AS VARCHAR), 'd ago') END AS age_text
FROM (SELECT last_received_timestamp,
             greatest(0, CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_received_timestamp)) / 1e6)
                              AS BIGINT)) AS s
      FROM (SELECT max("timestamp") AS last_received_timestamp FROM (SELECT "timestamp" FROM sensor_readings
            UNION ALL SELECT "timestamp" FROM production_events)))
""")
def q_freshness_state(spark, sf):
    """SC-9: freshness of the newest record at a fixed as-of time."""
    return rm.freshness(t.sensor(spark, sf), t.production(spark, sf), AS_OF)


@register("risk_posture", sql="""
SELECT CASE WHEN a > 0 THEN a ELSE p END AS high_risk_count,
       CASE WHEN a > 0 THEN 'alerts' ELSE 'predictions' END AS basis
FROM (SELECT (SELECT count(*) FROM alerts WHERE lower(severity) IN ('high', 'critical')) AS a,
             (SELECT count(*) FROM scored_h WHERE lower(risk_level) IN ('high', 'critical')) AS p)
""", extra_ctes=SCORED_CTES)
def q_risk_posture(spark, sf):
    """SC-11: count of high/critical alerts, else of predictions."""
    return rm.risk_posture(alerts(spark, sf), scored(spark, sf))


@register("trend_series", sql="""
SELECT id, line_id, station_id, "timestamp", metric, round(value, 6) AS value
FROM (SELECT id, line_id, station_id, "timestamp",
             CAST(throughput_count AS DOUBLE) AS throughput_count,
             CAST(target_throughput AS DOUBLE) AS target_throughput,
             CAST(cycle_time_sec AS DOUBLE) AS cycle_time_sec, CAST(station_yield AS DOUBLE) AS station_yield,
             CAST(defect_rate AS DOUBLE) AS defect_rate, CAST(micro_stop_count AS DOUBLE) AS micro_stop_count,
             CAST(downtime_minutes AS DOUBLE) AS downtime_minutes
      FROM production_events)
UNPIVOT INCLUDE NULLS (value FOR metric IN (throughput_count, target_throughput, cycle_time_sec, station_yield,
                                            defect_rate, micro_stop_count, downtime_minutes))
""")
def q_trend_series(spark, sf):
    """SC-12: tidy (line, station, time, metric, value) production series."""
    return rm.trend_series(t.production(spark, sf))


def _queue_sql(max_items):
    return f"""
SELECT priority, area, asset, signal, suggested_action FROM (
  SELECT * FROM (
    SELECT priority, area, asset, signal, suggested_action,
           min(struct_pack(f := feed, a := sa, b := sb)) AS o
    FROM (
      SELECT CASE WHEN lower(risk_level) = 'critical' THEN 'P1' ELSE 'P2' END AS priority,
             concat(coalesce(line_id, 'N/A'), ' / ', coalesce(station_id, 'N/A')) AS area,
             coalesce(machine_id, 'N/A') AS asset,
             concat(upper(risk_level), ' risk, health ',
                    CASE WHEN health_score IS NULL THEN 'N/A' ELSE printf('%.2f', health_score) END) AS signal,
             coalesce(recommended_action, '{rm.DEFAULT_PREDICTION_ACTION}') AS suggested_action,
             1 AS feed, epoch_us("timestamp") AS sa, machine_id AS sb
      FROM latest WHERE lower(risk_level) IN ('high', 'critical')
      UNION ALL
      SELECT CASE WHEN lower(severity) = 'critical' THEN 'P1' ELSE 'P2' END,
             concat(coalesce(line_id, 'N/A'), ' / ', coalesce(station_id, 'N/A')),
             coalesce(machine_id, 'N/A'),
             concat('Anomaly alert: ', coalesce(CAST(anomaly_score AS VARCHAR), 'N/A')),
             coalesce(message, '{rm.DEFAULT_ALERT_ACTION}'), 2, -id, ''
      FROM (SELECT * FROM alerts ORDER BY id DESC LIMIT {max_items})
      UNION ALL
      SELECT 'P3', concat(coalesce(line_id, 'N/A'), ' / ', coalesce(station_id, 'N/A')),
             coalesce(machine_id, entity_id, 'N/A'), concat('Data quality: ', coalesce(issue_type, 'N/A')),
             '{rm.ISSUE_ACTION}', 3, -epoch_us("timestamp"), entity_id
      FROM (SELECT * FROM issues
            WHERE (lower(severity) IN ('high', 'critical'))
               OR NOT EXISTS (SELECT 1 FROM issues WHERE lower(severity) IN ('high', 'critical'))
            ORDER BY "timestamp" DESC NULLS LAST, entity_id DESC NULLS LAST, issue_type LIMIT 3)
    ) u GROUP BY ALL
  ) g
  ORDER BY CASE priority WHEN 'P1' THEN 0 WHEN 'P2' THEN 1 WHEN 'P3' THEN 2 WHEN 'Monitor' THEN 3 ELSE 9 END,
           area, o, signal, asset, suggested_action
  LIMIT {max_items})
UNION ALL
SELECT {", ".join(f"'{v}'" for v in rm.MONITOR_ROW)}
WHERE NOT EXISTS (SELECT 1 FROM latest WHERE lower(risk_level) IN ('high', 'critical'))
  AND NOT EXISTS (SELECT 1 FROM alerts) AND NOT EXISTS (SELECT 1 FROM issues)
"""


@register("action_queue", sql=_queue_sql(8), extra_ctes=SCORED_CTES + "," + ISSUES_CTE)
def q_action_queue(spark, sf):
    """SC-5: top-8 operator action queue from risky machines, alerts and data-quality issues."""
    return rm.action_queue(latest(spark, sf), alerts(spark, sf), issues(spark, sf), 8)


@register("shift_report", sql="""
SELECT (SELECT count(*) FROM sensor_readings) AS sensor_readings,
       (SELECT count(*) FROM production_events) AS production_events,
       (SELECT count(*) FROM scored_h) AS predictions,
       (SELECT count(*) FROM alerts) AS anomaly_alerts,
       (SELECT count(*) FROM issues) AS data_quality_issues,
       0::BIGINT AS model_runs,
       (SELECT round(avg(health_score), 6) FROM latest) AS avg_health_score,
       (SELECT round(avg(rul_estimate_hours), 6) FROM latest) AS avg_rul_hours,
       (SELECT max("timestamp") FROM scored_h) AS latest_prediction_timestamp,
       CASE WHEN (SELECT count(*) FROM alerts) > 0 THEN (SELECT count(*) FROM alerts)
            ELSE (SELECT CAST(coalesce(sum(coalesce(anomaly_flag, 0)), 0) AS BIGINT) FROM scored_h) END AS anomaly_count
""", extra_ctes=SCORED_CTES + "," + ISSUES_CTE)
def q_shift_report(spark, sf):
    """SC-10: shift handover summary as one row."""
    return rm.shift_report(t.sensor(spark, sf), t.production(spark, sf), scored(spark, sf),
                           alerts(spark, sf), issues(spark, sf), latest(spark, sf))


@register("line_monitor", sql="""
SELECT line_id, count(*) AS events, round(avg(cycle_time_sec), 6) AS avg_cycle_time_sec,
       round(avg(station_yield), 6) AS avg_station_yield, round(sum(downtime_minutes), 6) AS total_downtime_minutes
FROM production_events WHERE line_id IN ('L1', 'L3') GROUP BY line_id
""")
def q_line_monitor(spark, sf):
    """AG-9 / SRC-3 / PRJ-9: line monitor KPIs through parameterised SQL on a temp view."""
    from ..sources.tables import read_query

    rows = read_query(spark, "SELECT * FROM production_events WHERE line_id IN (:a, :b)",
                      {"production_events": t.production(spark, sf)}, {"a": "L1", "b": "L3"})
    return rm.line_monitor_kpis(rows)


@register("output_validation", sql="""
SELECT table_name, row_count, minimum, CASE WHEN row_count >= minimum THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT 'sensor_readings' AS table_name, (SELECT count(*) FROM sensor_readings) AS row_count, 1::BIGINT AS minimum
      UNION ALL SELECT 'production_events', (SELECT count(*) FROM production_events), 1
      UNION ALL SELECT 'predictions', (SELECT count(*) FROM scored_h), 1
      UNION ALL SELECT 'anomaly_alerts', (SELECT count(*) FROM alerts), 1
      UNION ALL SELECT 'data_quality_issues', (SELECT count(*) FROM issues), 1)
""", extra_ctes=SCORED_CTES + "," + ISSUES_CTE)
def q_output_validation(spark, sf):
    """AG-13: row counts of the output tables with PASS/FAIL checks."""
    return rm.output_validation({"sensor_readings": t.sensor(spark, sf), "production_events": t.production(spark, sf),
                                 "predictions": scored(spark, sf), "anomaly_alerts": alerts(spark, sf),
                                 "data_quality_issues": issues(spark, sf)})


@register("shift_distribution", sql="""
SELECT shift, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM production_events GROUP BY shift
""")
def q_shift_distribution(spark, sf):
    """AG-14: production events per shift (DAY / EVENING / NIGHT)."""
    return rm.distribution(t.production(spark, sf), "shift")


@register("time_span", sql="""
SELECT min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp
FROM (SELECT "timestamp" FROM sensor_readings UNION ALL SELECT "timestamp" FROM production_events
      UNION ALL SELECT "timestamp" FROM scored_h UNION ALL SELECT "timestamp" FROM alerts)
""", extra_ctes=SCORED_CTES)
def q_time_span(spark, sf):
    """AG-15: first and last timestamp across sensor, production, prediction and alert tables."""
    return rm.time_span(t.sensor(spark, sf), t.production(spark, sf), scored(spark, sf), alerts(spark, sf))


@register("latest_events", sql="""
SELECT id, machine_id, line_id, station_id, "timestamp" FROM sensor_readings
ORDER BY "timestamp" DESC, id DESC LIMIT 10
""")
def q_latest_events(spark, sf):
    """SO-3: the ten newest sensor readings (top-k by time, id as tie-break)."""
    s = t.sensor(spark, sf)
    return (s.orderBy(F.col("timestamp").desc(), F.col("id").desc()).limit(10)
            .select("id", "machine_id", "line_id", "station_id", "timestamp"))


@register("training_alerts", sql=f"""
SELECT id, machine_id, line_id, station_id, "timestamp", round(anomaly_score, 6) AS anomaly_score,
       CASE WHEN anomaly_score < -0.15 THEN 'high' ELSE 'medium' END AS severity,
       '{sc.TRAINING_ALERT_MESSAGE}' AS message, 'training_pipeline' AS source
FROM predictions WHERE anomaly_flag = 1 ORDER BY anomaly_score ASC, id ASC LIMIT 100
""")
def q_training_alerts(spark, sf):
    """SC-8 / SO-2: the 100 most anomalous flagged rows as alerts (given scores)."""
    return sc.training_alerts(t.predictions(spark, sf), 100)


@register("sensor_trends", sql="""
SELECT id, machine_id, station_id, "timestamp", metric, round(value, 6) AS value
FROM (SELECT id, machine_id, station_id, "timestamp", vibration_rms, process_temperature, motor_current, torque,
             tool_wear FROM sensor_readings)
UNPIVOT INCLUDE NULLS (value FOR metric IN (vibration_rms, process_temperature, motor_current, torque, tool_wear))
""")
def q_sensor_trends(spark, sf):
    """SC-12: per-machine sensor trend series (tidy)."""
    return rm.trend_series(t.sensor(spark, sf), rm.SENSOR_TREND_METRICS,
                           keys=("id", "machine_id", "station_id", "timestamp"))


@register("anomaly_timeline", sql="""
SELECT id, machine_id, line_id, "timestamp", round(anomaly_score, 6) AS anomaly_score,
       coalesce(anomaly_flag, 0) AS anomaly_flag FROM scored_h
""", extra_ctes=SCORED_CTES)
def q_anomaly_timeline(spark, sf):
    """SC-12: anomaly score and flag over time per machine."""
    return rm.anomaly_timeline(scored(spark, sf))


@register("shift_report_queue", sql=_queue_sql(5), extra_ctes=SCORED_CTES + "," + ISSUES_CTE)
def q_shift_report_queue(spark, sf):
    """SC-10: the top-5 action queue printed in the shift handover report."""
    return rm.action_queue(latest(spark, sf), alerts(spark, sf), issues(spark, sf), 5)
