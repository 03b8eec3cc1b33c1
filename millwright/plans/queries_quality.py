"""Registered data-quality queries (DQ-1..12) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as q
from . import tables as t
from .catalog import register

# Fixture thresholds: events are hours apart, so the gap rule uses 4 h x 6 = 1 day.
GAP_INTERVAL_SECONDS = 14_400
ID = 'entity_id, machine_id, line_id, station_id, "timestamp"'
SENSOR_ID = f"CAST(id AS VARCHAR) AS entity_id, machine_id, line_id, station_id, \"timestamp\""
PROD_ID = "CAST(id AS VARCHAR) AS entity_id, CAST(NULL AS VARCHAR) AS machine_id, line_id, station_id, \"timestamp\""


def _head(issue_type, severity, entity):
    return f"'{issue_type}' AS issue_type, '{severity}' AS severity, '{entity}' AS entity_type"


@register("dq_missing_values", sql=f"""
SELECT {_head('missing_value', 'high', 'sensor_reading')}, {SENSOR_ID}, id AS row_id,
       concat_ws(',', {", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in q.S.SENSOR_REQUIRED_COLUMNS)})
         AS missing_columns
FROM sensor_readings
WHERE {" OR ".join(f'"{c}" IS NULL' for c in q.S.SENSOR_REQUIRED_COLUMNS)}
""")
def q_dq_missing_values(spark, sf):
    """DQ-2: one issue per sensor row listing its null required columns."""
    out = q.flatten(q.missing_values(t.sensor(spark, sf), q.S.SENSOR_REQUIRED_COLUMNS, q.SENSOR))
    return out.withColumn("missing_columns", F.array_join("missing_columns", ","))


@register("dq_duplicates", sql=f"""
SELECT {_head('duplicate_timestamp', 'medium', 'sensor_reading')}, {SENSOR_ID}
FROM (SELECT *, count(*) OVER (PARTITION BY machine_id, station_id, "timestamp") AS n FROM sensor_readings)
WHERE n > 1
""")
def q_dq_duplicates(spark, sf):
    """DQ-3: every reading that shares (machine, station, timestamp) with another."""
    out = q.duplicate_timestamps(t.sensor(spark, sf), ["machine_id", "station_id"], q.SENSOR)
    return out.select(*q.ISSUE_COLUMNS)


@register("dq_gaps", sql=f"""
SELECT {_head('timestamp_gap', 'medium', 'sensor_reading')}, {SENSOR_ID},
       concat_ws('|', machine_id, station_id) AS group_key, round(gap, 6) AS gap_seconds,
       86400.0::DOUBLE AS threshold_seconds
FROM (SELECT *, (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (
        PARTITION BY machine_id, station_id ORDER BY "timestamp", id))) / 1e6 AS gap
      FROM sensor_readings)
WHERE gap > 86400
""")
def q_dq_gaps(spark, sf):
    """DQ-4: readings more than a day after the previous one of the same machine."""
    out = q.flatten(q.timestamp_gaps(t.sensor(spark, sf), ["machine_id", "station_id"], q.SENSOR,
                                     expected_interval_seconds=GAP_INTERVAL_SECONDS))
    return out.drop("group_columns")


def _rule_sql(table, rules, entity, ident):
    parts = []
    for col, cond in rules:
        parts.append(f"SELECT {_head('impossible_value', 'high', entity)}, {ident}, '{col}' AS \"column\", "
                     f"round(CAST({col} AS DOUBLE), 6) AS value FROM {table} WHERE {cond.format(c=col)}")
    return "\nUNION ALL\n".join(parts)


_S_RULES = [(r.column, "{c} < 0" if r.violates is q._neg else "({c} < 0 OR {c} > 100)")
            for r in q.SENSOR_VALUE_RULES]
_P_COND = {q._neg: "{c} < 0", q._out01: "({c} < 0 OR {c} > 1)", q._nonpos: "{c} <= 0"}
_P_RULES = [(r.column, _P_COND[r.violates]) for r in q.PRODUCTION_VALUE_RULES]


@register("dq_impossible_sensor", sql=_rule_sql("sensor_readings", _S_RULES, "sensor_reading", SENSOR_ID))
def q_dq_impossible_sensor(spark, sf):
    """DQ-5: one issue per (reading, column) outside its physical range."""
    return q.flatten(q.impossible_sensor_values(t.sensor(spark, sf)))


@register("dq_impossible_production", sql=_rule_sql("production_events", _P_RULES, "production_event", PROD_ID))
def q_dq_impossible_production(spark, sf):
    """DQ-6: ratios outside [0,1], non-positive cycle time, negative counts."""
    return q.flatten(q.impossible_production_values(t.production(spark, sf)))


_STUCK_SQL_COLS = q.STUCK_COLUMNS
_W = 'PARTITION BY machine_id, station_id ORDER BY "timestamp", id'


def _stuck_sql():
    unions = []
    for c in _STUCK_SQL_COLS:
        unions.append(f"""
  SELECT id, machine_id, line_id, station_id, "timestamp", '{c}' AS col, {c} AS v,
         coalesce(abs({c} - lag({c}) OVER ({_W})) < 1e-9, false) AS same
  FROM sensor_readings""")
    return "\nUNION ALL".join(unions)


_STUCK_QUERY = f"""
SELECT {_head('stuck_sensor', 'high', 'sensor_reading')}, CAST(id AS VARCHAR) AS entity_id, machine_id, line_id,
       station_id, "timestamp", col AS "column", 6 AS min_run_length, round(v, 6) AS example_value
FROM (
  SELECT *, row_number() OVER (PARTITION BY machine_id, station_id, col ORDER BY "timestamp" DESC, id DESC) AS rk
  FROM (
    SELECT *, sum(CASE WHEN same THEN 1 ELSE 0 END) OVER (PARTITION BY machine_id, station_id, col, run) + 1 AS run_len
    FROM (
      SELECT *, sum(CASE WHEN chg THEN 1 ELSE 0 END) OVER (PARTITION BY machine_id, station_id, col
             ORDER BY "timestamp", id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM (
        SELECT *, same IS DISTINCT FROM lag(same) OVER (PARTITION BY machine_id, station_id, col
               ORDER BY "timestamp", id) AS chg
        FROM ({_stuck_sql()}) u) a) b) c
  WHERE same AND run_len >= 6) d
WHERE rk = 1
"""


@register("dq_stuck_sensor", sql=_STUCK_QUERY)
def q_dq_stuck_sensor(spark, sf):
    """DQ-7: flatlined sensor columns; last stuck reading per (machine, station, column)."""
    out = q.stuck_sensor(t.sensor(spark, sf))
    return out.select(*q.ISSUE_COLUMNS, "details.column", "details.min_run_length", "details.example_value")


@register("dq_dropout", sql=f"""
SELECT {_head('sensor_dropout', 'high', 'sensor_reading')}, {SENSOR_ID}, id AS row_id,
       ({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in q.DROPOUT_COLUMNS)}) AS missing_sensor_columns,
       5 AS threshold
FROM sensor_readings
WHERE ({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in q.DROPOUT_COLUMNS)}) >= 5
""")
def q_dq_dropout(spark, sf):
    """DQ-8: readings with five or more of nine sensor values missing."""
    return q.flatten(q.sensor_dropout(t.sensor(spark, sf)))


@register("dq_delayed", sql=f"""
SELECT {_head('delayed_reading', 'medium', 'production_event')}, {PROD_ID},
       round((epoch_us(created_at) - epoch_us("timestamp")) / 1e6, 6) AS delay_seconds, 60 AS threshold_seconds
FROM production_events WHERE (epoch_us(created_at) - epoch_us("timestamp")) / 1e6 > 60
""")
def q_dq_delayed(spark, sf):
    """DQ-9: production events that arrived more than 60 s after they happened."""
    return q.flatten(q.delayed_readings(t.production(spark, sf), q.PRODUCTION))


# ----------------------------------------------------------------- suites (DQ-11 / DQ-12)
def _ident(table):
    return SENSOR_ID if table == "sensor_readings" else PROD_ID


def sql_missing(table, cols, entity):
    return (f"SELECT {_head('missing_value', 'high', entity)}, {_ident(table)} FROM {table} WHERE "
            + " OR ".join(f'"{c}" IS NULL' for c in cols))


def sql_dups(table, keys, entity):
    return (f"SELECT {_head('duplicate_timestamp', 'medium', entity)}, {_ident(table)} FROM "
            f"(SELECT *, count(*) OVER (PARTITION BY {', '.join(keys)}, \"timestamp\") AS n FROM {table}) "
            f"WHERE n > 1")


def sql_gaps(table, keys, entity, threshold):
    return (f"SELECT {_head('timestamp_gap', 'medium', entity)}, {_ident(table)} FROM "
            f"(SELECT *, (epoch_us(\"timestamp\") - epoch_us(lag(\"timestamp\") OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY \"timestamp\", id))) / 1e6 AS gap FROM {table}) WHERE gap > {threshold}")


def sql_values(table, rules, entity):
    return "\nUNION ALL\n".join(
        f"SELECT {_head('impossible_value', 'high', entity)}, {_ident(table)} FROM {table} "
        f"WHERE {cond.format(c=col)}" for col, cond in rules)


def sql_delay(table, entity):
    return (f"SELECT {_head('delayed_reading', 'medium', entity)}, {_ident(table)} FROM {table} "
            f"WHERE (epoch_us(created_at) - epoch_us(\"timestamp\")) / 1e6 > 60")


_DROP_SUM = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in q.DROPOUT_COLUMNS)

SENSOR_ISSUES_SQL = "\nUNION ALL\n".join([
    sql_missing("sensor_readings", q.S.SENSOR_REQUIRED_COLUMNS, "sensor_reading"),
    sql_dups("sensor_readings", ["machine_id", "station_id"], "sensor_reading"),
    sql_gaps("sensor_readings", ["machine_id", "station_id"], "sensor_reading", 86400),
    sql_values("sensor_readings", _S_RULES, "sensor_reading"),
    f"""SELECT issue_type, severity, entity_type, entity_id, machine_id, line_id, station_id, "timestamp"
FROM ({_STUCK_QUERY})""",
    f"SELECT {_head('sensor_dropout', 'high', 'sensor_reading')}, {SENSOR_ID} FROM sensor_readings "
    f"WHERE ({_DROP_SUM}) >= 5",
    sql_delay("sensor_readings", "sensor_reading"),
])

PRODUCTION_ISSUES_SQL = "\nUNION ALL\n".join([
    sql_missing("production_events", q.S.PRODUCTION_REQUIRED_COLUMNS, "production_event"),
    sql_dups("production_events", ["line_id", "station_id"], "production_event"),
    sql_gaps("production_events", ["line_id", "station_id"], "production_event", 86400),
    sql_values("production_events", _P_RULES, "production_event"),
    sql_delay("production_events", "production_event"),
])

ISSUES_CTE = f"issues AS (\n{SENSOR_ISSUES_SQL}\nUNION ALL\n{PRODUCTION_ISSUES_SQL}\n)"


def issues(spark, sf):
    """Both rule suites over the fixture tables (issue table with details_json)."""
    return q.run_quality_checks(t.sensor(spark, sf), t.production(spark, sf),
                                gap_interval_seconds=GAP_INTERVAL_SECONDS)


@register("dq_all_sensor", sql=f"SELECT * FROM ({SENSOR_ISSUES_SQL})")
def q_dq_all_sensor(spark, sf):
    """DQ-11: the sensor suite (rules 1, 2, 3, 4, 5, 7, 8, 9) as one issue table."""
    out = q.validate_sensor_readings(t.sensor(spark, sf), gap_interval_seconds=GAP_INTERVAL_SECONDS)
    return out.select(*q.ISSUE_COLUMNS)


@register("dq_summary", sql="""
SELECT entity_type, issue_type, count(*) AS issue_count FROM issues GROUP BY entity_type, issue_type
""", extra_ctes=ISSUES_CTE)
def q_dq_summary(spark, sf):
    """DQ-12: issue counts by table and type over both suites."""
    return q.quality_summary(issues(spark, sf))


def _flat_sql():
    return f"""
SELECT DISTINCT id, 1 AS flatline_sensor_flag FROM (
  SELECT *, sum(CASE WHEN same THEN 1 ELSE 0 END) OVER (PARTITION BY machine_id, station_id, col, run) + 1 AS run_len
  FROM (
    SELECT *, sum(CASE WHEN chg THEN 1 ELSE 0 END) OVER (PARTITION BY machine_id, station_id, col
           ORDER BY "timestamp", id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
    FROM (
      SELECT *, same IS DISTINCT FROM lag(same) OVER (PARTITION BY machine_id, station_id, col
             ORDER BY "timestamp", id) AS chg
      FROM ({_stuck_sql()}) u) a) b) c
WHERE same AND run_len >= 6
"""


@register("flatline_flags", sql=_flat_sql())
def q_flatline_flags(spark, sf):
    """Q6 / DQ-7: readings inside a flatline run of any watched column."""
    return q.flatline_flags(t.sensor(spark, sf))
