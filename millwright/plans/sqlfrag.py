"""Small SQL text builders for the oracle queries (DuckDB dialect)."""


def clip(expr: str, lo=None, hi=None) -> str:
    inner = expr
    if hi is not None:
        inner = f"least({hi}, {inner})"
    if lo is not None:
        inner = f"greatest({lo}, {inner})"
    return f"(CASE WHEN ({expr}) IS NULL THEN NULL ELSE {inner} END)"


def clip01(expr: str) -> str:
    return clip(expr, "0.0", "1.0")


def secs(later: str, earlier: str) -> str:
    return f"((epoch_us({later}) - epoch_us({earlier})) / 1e6)"


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


# The as-of join of the fixture views (6 h tolerance).  Ties on the sensor
# timestamp are reduced to the highest sensor id first.
ASOF_CTES = """
s_top AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY line_id, station_id, "timestamp" ORDER BY id DESC) AS rn
    FROM sensor_readings WHERE line_id IS NOT NULL AND station_id IS NOT NULL AND "timestamp" IS NOT NULL)
  WHERE rn = 1
),
joined AS (
  SELECT p.id AS id_prod, p.event_id AS event_id_prod, p.line_id, p.station_id, p."timestamp",
         p.batch_id, p.shift, p.cycle_time_sec, p.throughput_count, p.target_throughput, p.station_yield,
         p.reject_count, p.rework_count, p.defect_rate, p.micro_stop_count, p.downtime_minutes,
         p.wip_count, p.queue_length, p.inspection_score_proxy, p.process_stability_index,
         p.operator_group, p.created_at AS created_at_prod,
         s.id, s.event_id, s.machine_id, s.air_temperature, s.process_temperature, s.vibration_rms,
         s.vibration_peak, s.pressure, s.torque, s.rotational_speed, s.motor_current, s.power_consumption,
         s.tool_wear, s.operating_hours, s.production_load, s.ambient_humidity, s.created_at,
         p."timestamp" AS event_timestamp, s."timestamp" AS sensor_timestamp,
         (epoch_us(p."timestamp") - epoch_us(s."timestamp")) / 1e6 AS join_lag_seconds
  FROM production_events p ASOF JOIN s_top s
    ON p.line_id = s.line_id AND p.station_id = s.station_id AND p."timestamp" >= s."timestamp"
  WHERE (epoch_us(p."timestamp") - epoch_us(s."timestamp")) / 1e6 <= 21600
)
"""
