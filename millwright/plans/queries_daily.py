"""Registered queries of the daily partial results, issue marginals and details, and quantile sketches.

Their SQL is written out from the rule catalogue and shares no constant with the engine.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..ml import stats as st
from ..operators import daily
from ..operators import quality as q
from ..operators import readmodels as rm
from ..session import cut_lineage, scratch_path
from ..sources import ingest as ig
from . import tables as t
from .catalog import register
from .queries_features import _feats
from .queries_ingest import BAD_TS_MOD, NO_MACHINE_MOD, TRUNCATED_MOD, damaged_sensor_lines
from .queries_ml import FEAT_CTES
from .queries_quality import ISSUES_CTE, issues
from .queries_readmodels import SCORED_CTES, alerts, scored


# Lines that the contract turns away, see ``queries_ingest.damaged_sensor_lines``.
_BAD_LINE = f"(id % {TRUNCATED_MOD} = 0 OR id % {BAD_TS_MOD} = 0 OR id % {NO_MACHINE_MOD} = 0)"


# ----------------------------------------------------------------- daily partial results
def _days(spark, sf) -> str:
    """All days' partial results, written to a scratch folder."""
    root = scratch_path(spark, "daily")
    predictions = cut_lineage(scored(spark, sf).drop("risk_components"))
    daily.write_days(root, daily.partials(t.sensor(spark, sf), t.production(spark, sf), issues(spark, sf), predictions, alerts(spark, sf)))
    return root


@register("executive_kpis_daily", sql="""
SELECT (SELECT count(DISTINCT machine_id) FROM sensor_readings) AS total_machines,
       (SELECT count(DISTINCT line_id) FROM (SELECT line_id FROM sensor_readings
          UNION ALL SELECT line_id FROM production_events)) AS total_lines,
       (SELECT count(*) FILTER (WHERE risk_level IN ('high', 'critical')) FROM latest) AS critical_machines,
       (SELECT round(avg(health_score), 6) FROM latest) AS avg_health_score,
       (SELECT round(avg(rul_estimate_hours), 6) FROM latest) AS avg_rul_hours,
       CASE WHEN (SELECT count(*) FROM alerts) > 0 THEN (SELECT count(*) FROM alerts)
            ELSE (SELECT CAST(coalesce(sum(coalesce(anomaly_flag, 0)), 0) AS BIGINT) FROM scored_h) END AS anomaly_count
""", extra_ctes=SCORED_CTES)
def q_executive_kpis_daily(spark, sf):
    """AG-4 merged from daily partial results instead of the whole history."""
    return daily.executive_kpis(spark, _days(spark, sf))


@register("acquisition_status_daily", sql="""
SELECT (SELECT count(*) FROM sensor_readings) AS sensor_readings,
       (SELECT count(*) FROM production_events) AS production_events,
       (SELECT count(*) FROM issues) AS data_quality_issues,
       (SELECT max("timestamp") FROM sensor_readings) AS latest_sensor_timestamp,
       (SELECT max("timestamp") FROM production_events) AS latest_production_timestamp
""", extra_ctes=ISSUES_CTE)
def q_acquisition_status_daily(spark, sf):
    """AG-1 merged from daily partial results."""
    return daily.acquisition_status(spark, _days(spark, sf))


# ----------------------------------------------------------------- AG-8, SRC-9
@register("ingestion_kpis_logged", sql=f"""
SELECT (SELECT max("timestamp") FROM (SELECT "timestamp" FROM sensor_readings
          UNION ALL SELECT "timestamp" FROM production_events)) AS last_received_timestamp,
       (SELECT count(*) FROM sensor_readings) + (SELECT count(*) FROM production_events) AS successful_ingestion_count,
       (SELECT count(*) FROM sensor_readings WHERE {_BAD_LINE}) AS failed_ingestion_count,
       (SELECT count(*) FROM issues WHERE issue_type = 'delayed_reading') AS delayed_readings,
       (SELECT count(*) FROM issues WHERE issue_type IN ('timestamp_gap', 'sensor_dropout'))
         + (SELECT count(*) FROM sensor_readings WHERE {_BAD_LINE}) AS buffered_records_proxy
""", extra_ctes=ISSUES_CTE)
def q_ingestion_kpis_logged(spark, sf):
    """AG-8 with the acquisition log: each delivered line is an entry, a rejected one has failed."""
    lines = ig.classify_records(damaged_sensor_lines(spark, sf), S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS)
    logs = lines.select(F.when(F.col("is_valid"), "OK").otherwise("FAILED").alias("status"))
    return rm.ingestion_kpis(t.sensor(spark, sf), t.production(spark, sf), issues(spark, sf), logs)


@register("wide_quality_events", sql="""
SELECT issue_type, severity, entity_type, machine_id, line_id, station_id, "timestamp", entity_id AS reference, 'generator' AS source FROM issues
""", extra_ctes=ISSUES_CTE)
def q_wide_quality_events(spark, sf):
    """SRC-9: data-quality events of the wide source (upper-case types, table names) mapped to issue rows."""
    events = issues(spark, sf).select(
        F.upper("issue_type").alias("issue_type"), "severity", F.col("entity_type").alias("affected_table"), "machine_id", "line_id", "station_id",
        "timestamp", F.to_json(F.struct(F.col("entity_id").alias("reference"))).alias("details_json"))
    mapped = ig.wide_quality_events_to_issues(events)
    return q.with_details(mapped, {"reference": ("$.reference", "string")}).drop("details_json")


# ----------------------------------------------------------------- AG-6
@register("issue_count_marginals", sql="""
SELECT coalesce(issue_type, 'unknown') AS issue_type, coalesce(severity, 'unknown') AS severity, count(*) AS issue_count,
       'type_severity' AS level, NULL AS type_rank FROM issues GROUP BY 1, 2
UNION ALL SELECT issue_type, NULL, n, 'type', CAST(row_number() OVER (ORDER BY n DESC, issue_type) AS INTEGER)
          FROM (SELECT coalesce(issue_type, 'unknown') AS issue_type, count(*) AS n FROM issues GROUP BY 1)
UNION ALL SELECT NULL, coalesce(severity, 'unknown'), count(*), 'severity', NULL FROM issues GROUP BY 2
UNION ALL SELECT NULL, NULL, count(*), 'total', NULL FROM issues
""", extra_ctes=ISSUES_CTE)
def q_issue_count_marginals(spark, sf):
    """AG-6: counts by type and severity, by type in falling order, by severity and in total, in one pass."""
    return rm.issue_marginals(issues(spark, sf))


# ----------------------------------------------------------------- AG-11
@register("risk_quantiles_sketch", sql="""
SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.85::DOUBLE, 0.99::DOUBLE]) AS q, n, TRUE AS within_bound
FROM (SELECT count(equipment_process_risk_index) AS n FROM risk_f)
""", extra_ctes=FEAT_CTES)
def q_risk_quantiles_sketch(spark, sf):
    """AG-11: risk quantiles from one sketch for each day; the rank of each in all rows is within the stated error."""
    rows = cut_lineage(_feats(spark, sf).select("timestamp", "equipment_process_risk_index"))
    days = cut_lineage(st.quantile_sketches(rows, "equipment_process_risk_index", [F.to_date("timestamp")]))
    values = cut_lineage(st.sketch_quantiles(days, [0.25, 0.5, 0.75, 0.85, 0.99]))
    ranks = st.rank_range(rows, "equipment_process_risk_index", values)
    error = F.lit(st.SKETCH_RANK_ERROR) + 1 / F.col("n")  # one row is a step of its own in a small table
    within = (F.col("below") - error <= F.col("q")) & (F.col("q") <= F.col("upto") + error)
    return ranks.select("q", "n", within.alias("within_bound"))


# ----------------------------------------------------------------- issue details
# The rule catalogue's columns, as text.
_SENSOR_REQUIRED = ("machine_id line_id station_id timestamp air_temperature process_temperature vibration_rms vibration_peak pressure "
                    "torque rotational_speed motor_current power_consumption tool_wear operating_hours production_load ambient_humidity").split()
_PRODUCTION_REQUIRED = ("line_id station_id batch_id shift timestamp cycle_time_sec throughput_count target_throughput station_yield "
                        "reject_count rework_count defect_rate micro_stop_count downtime_minutes wip_count queue_length "
                        "inspection_score_proxy process_stability_index operator_group").split()
_NOT_NEGATIVE = "vibration_rms vibration_peak pressure torque rotational_speed motor_current power_consumption operating_hours production_load".split()
_PERCENT = ["tool_wear", "ambient_humidity"]
_SHARES = "station_yield defect_rate inspection_score_proxy process_stability_index".split()
_COUNTS = "throughput_count target_throughput reject_count rework_count micro_stop_count downtime_minutes wip_count queue_length".split()
_WATCHED = "air_temperature process_temperature vibration_rms pressure torque motor_current power_consumption".split()
_DROPPED = "air_temperature process_temperature vibration_rms vibration_peak pressure torque rotational_speed motor_current power_consumption".split()

_FIELDS = {
    "column": ("$.column", "string"), "value": ("$.value", "double"), "row_id": ("$.row_id", "long"),
    "first_missing": ("$.missing_columns[0]", "string"), "last_key": ("$.group_columns[1]", "string"), "group_key": ("$.group_key", "string"),
    "gap_seconds": ("$.gap_seconds", "double"), "threshold_seconds": ("$.threshold_seconds", "double"),
    "key_station": ("$.station_id", "string"), "min_run_length": ("$.min_run_length", "int"), "example_value": ("$.example_value", "double"),
    "missing_sensor_columns": ("$.missing_sensor_columns", "int"), "threshold": ("$.threshold", "int"),
    "delay_seconds": ("$.delay_seconds", "double"), "message": ("$.message", "string"),
}


def _detail_sql(kind: str, entity: str, table: str, where: str, **fields: str) -> str:
    own = ", ".join(f'CAST({fields[n]} AS {k}) AS "{n}"' if n in fields else f'CAST(NULL AS {k}) AS "{n}"'
                    for n, k in ((n, {"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}[t_]) for n, (_, t_) in _FIELDS.items()))
    ident = "NULL" if "message" in fields or kind == "missing_required_column" else "CAST(id AS VARCHAR)"
    return f"SELECT '{kind}' AS issue_type, '{entity}' AS entity_type, {ident} AS entity_id, {own} FROM {table} WHERE {where}"


def _gap_sql(table: str, entity: str, keys: tuple[str, str]) -> str:
    gaps = (f'(SELECT *, (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (PARTITION BY {keys[0]}, {keys[1]} ORDER BY "timestamp", id))) / 1e6 AS gap '
            f"FROM {table})")
    return _detail_sql("timestamp_gap", entity, gaps, "gap > 86400", last_key=f"'{keys[1]}'", gap_seconds="round(gap, 6)", threshold_seconds="86400",
                       group_key=f"concat(coalesce({keys[0]}, 'null'), '|', coalesce({keys[1]}, 'null'))")


def _twice_sql(table: str, entity: str, keys: tuple[str, str]) -> str:
    same = f'(SELECT *, count(*) OVER (PARTITION BY {keys[0]}, {keys[1]}, "timestamp") AS n FROM {table})'
    return _detail_sql("duplicate_timestamp", entity, same, "n > 1", key_station="station_id")


def _missing_sql(table: str, entity: str, required: list[str]) -> str:
    first = "CASE " + " ".join(f"WHEN \"{c}\" IS NULL THEN '{c}'" for c in required) + " END"
    return _detail_sql("missing_value", entity, table, f"{first} IS NOT NULL", row_id="id", first_missing=first)


def _value_sql(table: str, entity: str, rules: dict[str, str]) -> list[str]:
    return [_detail_sql("impossible_value", entity, table, cond, column=f"'{c}'", value=f"round(CAST({c} AS DOUBLE), 6)") for c, cond in rules.items()]


def _late_sql(table: str, entity: str) -> str:
    late = '(epoch_us(created_at) - epoch_us("timestamp")) / 1e6'
    return _detail_sql("delayed_reading", entity, table, f"{late} > 60", delay_seconds=f"round({late}, 6)", threshold_seconds="60")


def _stuck_detail_sql() -> str:
    w = 'PARTITION BY machine_id, station_id, col ORDER BY "timestamp", id'
    values = " UNION ALL ".join(f"SELECT id, machine_id, station_id, \"timestamp\", '{c}' AS col, {c} AS v FROM sensor_readings" for c in _WATCHED)
    same = f"SELECT *, coalesce(abs(v - lag(v) OVER ({w})) < 1e-9, false) AS same FROM ({values})"
    # five equal steps in a row, ending here, are six equal readings; their run's last row is reported
    run = f"SELECT *, sum(CASE WHEN same THEN 1 ELSE 0 END) OVER ({w} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS steps FROM ({same})"
    last = f"SELECT *, row_number() OVER (PARTITION BY machine_id, station_id, col ORDER BY \"timestamp\" DESC, id DESC) AS rk FROM ({run}) WHERE steps = 5"
    return _detail_sql("stuck_sensor", "sensor_reading", f"({last})", "rk = 1", column="col", min_run_length="6", example_value="round(v, 6)", key_station="station_id")


_DROPPED_N = " + ".join(f"({c} IS NULL)::INTEGER" for c in _DROPPED)
_DETAILS_SQL = "\nUNION ALL\n".join([
    _missing_sql("sensor_readings", "sensor_reading", _SENSOR_REQUIRED), _missing_sql("production_events", "production_event", _PRODUCTION_REQUIRED),
    _twice_sql("sensor_readings", "sensor_reading", ("machine_id", "station_id")),
    _twice_sql("production_events", "production_event", ("line_id", "station_id")),
    _gap_sql("sensor_readings", "sensor_reading", ("machine_id", "station_id")),
    _gap_sql("production_events", "production_event", ("line_id", "station_id")),
    *_value_sql("sensor_readings", "sensor_reading", {c: f"{c} < 0" for c in _NOT_NEGATIVE} | {c: f"({c} < 0 OR {c} > 100)" for c in _PERCENT}),
    *_value_sql("production_events", "production_event", {c: f"({c} < 0 OR {c} > 1)" for c in _SHARES} | {c: f"{c} < 0" for c in _COUNTS}
                | {"cycle_time_sec": "cycle_time_sec <= 0"}),
    _stuck_detail_sql(),
    _detail_sql("sensor_dropout", "sensor_reading", "sensor_readings", f"({_DROPPED_N}) >= 5", row_id="id", missing_sensor_columns=_DROPPED_N, threshold="5"),
    _late_sql("sensor_readings", "sensor_reading"), _late_sql("production_events", "production_event"),
    _detail_sql("missing_required_column", "sensor_reading", "(SELECT 'torque' AS c UNION ALL SELECT 'pressure')", "true", column="c"),
    _detail_sql("empty_table", "production_event", "(SELECT 1)", "true", message="'production_events table is empty'"),
])


@register("issue_details", sql=f"SELECT * FROM ({_DETAILS_SQL})")
def q_issue_details(spark, sf):
    """DQ-1..10: the details of every issue of all ten rules, read from their JSON as VARIANT."""
    sensor, production = t.sensor(spark, sf), t.production(spark, sf)
    # a table that lacks two columns, and one that has no rows
    absent = q.to_issue_table(q.missing_required_columns(sensor.drop("torque", "pressure"), q.S.SENSOR_REQUIRED_COLUMNS, q.SENSOR))
    empty = q.validate_production_events(production.where("false"))
    names = [*q.ISSUE_COLUMNS, "details_json"]
    every = issues(spark, sf).select(*names).unionByName(absent.select(*names)).unionByName(empty.select(*names))
    return q.with_details(every, _FIELDS).select("issue_type", "entity_type", "entity_id", *_FIELDS)
