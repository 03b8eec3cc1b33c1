"""The fixture views as SQL text, for the independent DuckDB oracle.

This is the same mapping as ``sources.fixtures`` written a second time, in
SQL, so the oracle does not share code with the engine under test.
Every oracle query is ``WITH <these views> <query>``.
"""

VIEWS_SQL = r"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         concat('M', CAST(user_id AS VARCHAR(20))) AS machine_id,
         concat('L', CAST(user_id % 5 AS VARCHAR(20))) AS line_id,
         concat('ST', CAST(user_id % 25 AS VARCHAR(20))) AS station_id,
         ts AS "timestamp",
         ts + (event_id % 120) * INTERVAL '1' SECOND AS created_at
  FROM events
),
sensor_base AS (
  SELECT event_id AS src_id, machine_id, line_id, station_id, "timestamp",
    CASE WHEN event_id % 71 = 0 THEN NULL ELSE 2.2e1 + k / 1e1 END AS air_temperature,
    CASE WHEN event_id % 71 = 0 THEN NULL ELSE 4e1 + value * 3e-1 END AS process_temperature,
    CASE WHEN event_id % 71 = 0 THEN NULL
         WHEN event_id % 97 = 0 THEN NULL
         WHEN event_id % 89 = 0 THEN -1e0
         WHEN user_id % 10 = 3 AND event_id % 5 <> 0 THEN 2.5e0
         ELSE value / 2.5e1 END AS vibration_rms,
    CASE WHEN event_id % 71 = 0 THEN NULL ELSE value * 1.2e-1 END AS vibration_peak,
    CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 83 = 0 THEN -5e0 ELSE 1e2 + k / 1e1 END AS pressure,
    1e1 + k * 3e-1 AS torque,
    1.8e3 - k * 2e0 AS rotational_speed,
    3e0 + value / 2e1 AS motor_current,
    1e0 + value / 5e1 AS power_consumption,
    k * 1.1e0 AS tool_wear,
    event_id / 1e1 AS operating_hours,
    5e-1 + k / 2e2 AS production_load,
    3e1 + k * 5e-1 AS ambient_humidity,
    created_at
  FROM ev WHERE event_type IN ('view', 'click', 'error')
),
sensor_readings AS (
  SELECT src_id AS id, concat('SEN_', CAST(src_id AS VARCHAR(20))) AS event_id,
         * EXCLUDE (src_id)
  FROM sensor_base
  UNION ALL
  SELECT -src_id - 1 AS id, concat('SEN_', CAST(src_id AS VARCHAR(20)), '_DUP') AS event_id,
         * EXCLUDE (src_id)
  FROM sensor_base WHERE src_id % 101 = 0
),
production_events AS (
  SELECT event_id AS id, concat('PROD_', CAST(event_id AS VARCHAR(20))) AS event_id,
    line_id, station_id,
    concat('B', CAST(event_id % 50 AS VARCHAR(20))) AS batch_id,
    CASE WHEN hour("timestamp") >= 6 AND hour("timestamp") < 14 THEN 'DAY'
         WHEN hour("timestamp") >= 14 AND hour("timestamp") < 22 THEN 'EVENING'
         ELSE 'NIGHT' END AS shift,
    "timestamp",
    CASE WHEN event_id % 73 = 0 THEN -1e0 ELSE 4e0 + value / 2e1 END AS cycle_time_sec,
    CASE WHEN event_id % 67 = 0 THEN NULL ELSE k % 20 END AS throughput_count,
    12 AS target_throughput,
    CASE WHEN event_id % 61 = 0 THEN 1.2e0 ELSE 9.9e-1 - k / 1e3 END AS station_yield,
    k % 5 AS reject_count,
    k % 3 AS rework_count,
    k / 5e2 AS defect_rate,
    k % 7 AS micro_stop_count,
    value / 1e1 AS downtime_minutes,
    k % 60 AS wip_count,
    k % 25 AS queue_length,
    9.5e-1 - k / 1e3 AS inspection_score_proxy,
    1e0 - k / 2e2 AS process_stability_index,
    CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS operator_group,
    created_at
  FROM ev WHERE event_type IN ('purchase', 'signup')
),
predictions AS (
  SELECT event_id AS id, machine_id, line_id, station_id, "timestamp",
    k / 1e2 AS failure_probability,
    value * 4e0 AS rul_estimate_hours,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE -value / 1e3 END AS anomaly_score,
    CASE WHEN value > 1.5e2 THEN 1 ELSE 0 END AS anomaly_flag,
    k * 1e0 AS tool_wear,
    1e0 - k / 2e2 AS process_stability_index,
    value * 2e-1 AS temperature_delta
  FROM ev
)
"""


def with_views(query: str, extra_ctes: str = "") -> str:
    ctes = VIEWS_SQL.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return "WITH " + ctes + "\n" + query.strip()
