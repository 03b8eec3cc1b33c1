"""Registered queries: scans, joins (SRC-1..3, JN-1..3, WN-7/8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, readmodels as rm
from ..sources import tables as src
from . import tables as t
from .catalog import register
from .sqlfrag import ASOF_CTES

ASOF_TOLERANCE_SECONDS = 6 * 3600  # fixture setting (FIXTURES.md 7.2)
ASOF_COLUMNS = ["id_prod", "event_id_prod", "line_id", "station_id", "timestamp", "id", "machine_id",
                "sensor_timestamp", "join_lag_seconds", "vibration_rms", "tool_wear", "cycle_time_sec"]


def joined(spark, sf):
    return asof.asof_join(t.sensor(spark, sf), t.production(spark, sf), ASOF_TOLERANCE_SECONDS)


@register("asof_join", sql="""
SELECT id_prod, event_id_prod, line_id, station_id, "timestamp", id, machine_id, sensor_timestamp,
       round(join_lag_seconds, 6) AS join_lag_seconds, round(vibration_rms, 6) AS vibration_rms,
       round(tool_wear, 6) AS tool_wear, round(cycle_time_sec, 6) AS cycle_time_sec
FROM joined
""", extra_ctes=ASOF_CTES)
def q_asof_join(spark, sf):
    """JN-1: production events <- latest sensor reading of the station within 6 h."""
    return joined(spark, sf).select(*ASOF_COLUMNS)


@register("latest_payload", sql="""
SELECT s.line_id, s.station_id, s.id AS sensor_id, s."timestamp" AS sensor_timestamp,
       round(s.vibration_rms, 6) AS sensor_vibration_rms,
       p.id AS production_id, p."timestamp" AS production_timestamp,
       round(p.cycle_time_sec, 6) AS production_cycle_time_sec
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line_id, station_id
        ORDER BY "timestamp" DESC, id DESC) AS rn FROM sensor_readings) WHERE rn = 1) s
JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line_id, station_id
        ORDER BY "timestamp" DESC, id DESC) AS rn FROM production_events) WHERE rn = 1) p
  ON s.line_id = p.line_id AND s.station_id = p.station_id
""")
def q_latest_payload(spark, sf):
    """JN-2: latest sensor row and latest production row per (line, station)."""
    pair = asof.latest_pair(t.sensor(spark, sf), t.production(spark, sf))
    return pair.select("line_id", "station_id", F.col("sensor_id"), "sensor_timestamp",
                       "sensor_vibration_rms", F.col("production_id"), "production_timestamp",
                       "production_cycle_time_sec")


SCORED_COLUMNS = ["id", "machine_id", "line_id", "station_id", "timestamp", "health_score", "risk_level"]


@register("latest_machine_health", sql="""
SELECT p.id, p.machine_id, p.line_id, p.station_id, p."timestamp", p.failure_probability
FROM predictions p
JOIN (SELECT machine_id, max("timestamp") AS mts FROM predictions WHERE machine_id IS NOT NULL
      GROUP BY machine_id) m
  ON p.machine_id = m.machine_id AND p."timestamp" = m.mts
""")
def q_latest_machine_health(spark, sf):
    """JN-3 / WN-8: prediction rows at each machine's latest timestamp (ties kept)."""
    latest = rm.latest_with_ties(t.predictions(spark, sf))
    return latest.select("id", "machine_id", "line_id", "station_id", "timestamp", "failure_probability")


@register("scan_latest_n", sql="""
SELECT id, machine_id, line_id, "timestamp", round(anomaly_score, 6) AS anomaly_score
FROM predictions ORDER BY id DESC LIMIT 100
""")
def q_scan_latest_n(spark, sf):
    """SRC-2 / SO-1: newest 100 rows by id (top-k is the feature)."""
    return src.read_latest(t.predictions(spark, sf), "id", 100).select(
        "id", "machine_id", "line_id", "timestamp", "anomaly_score")
