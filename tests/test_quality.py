"""Data-quality rules: the source system's cases plus boundary cases."""
from pyspark.sql import functions as F

from conftest import ts
from millwright import schemas as S
from millwright.operators import quality as q

SENSOR_COLS = ["id", "event_id", "machine_id", "line_id", "station_id", "timestamp"] + S.SENSOR_MEASURES + ["created_at"]


def sensor_rows(spark, rows):
    """rows: dicts with overrides of a healthy reading."""
    base = dict(machine_id="M1", line_id="L1", station_id="S1", air_temperature=28.0, process_temperature=58.0,
                vibration_rms=1.5, vibration_peak=4.5, pressure=115.0, torque=25.0, rotational_speed=1800.0,
                motor_current=7.5, power_consumption=3.2, tool_wear=35.0, operating_hours=1200.0,
                production_load=0.9, ambient_humidity=55.0)
    out = []
    for i, r in enumerate(rows):
        d = dict(base, id=i + 1, event_id=f"E{i + 1}", timestamp=ts(minutes=i))
        d.update(r)
        d.setdefault("created_at", d["timestamp"])
        out.append(tuple(d[c] for c in SENSOR_COLS))
    return spark.createDataFrame(out, S.SENSOR_SCHEMA)


def test_negative_vibration_reported(spark):
    df = sensor_rows(spark, [{"vibration_rms": -1.0}])
    got = q.flatten(q.impossible_sensor_values(df)).collect()
    assert [(r["column"], r["value"]) for r in got] == [("vibration_rms", -1.0)]


def test_value_bounds(spark):
    df = sensor_rows(spark, [{"tool_wear": 100.0}, {"tool_wear": 100.01}, {"ambient_humidity": -0.1},
                             {"air_temperature": -50.0}, {"pressure": None}])
    got = sorted((r["entity_id"], r["column"]) for r in q.flatten(q.impossible_sensor_values(df)).collect())
    assert got == [("2", "tool_wear"), ("3", "ambient_humidity")]


def test_production_bounds(spark):
    rows = [(1, "E1", "L", "S", "B", "DAY", ts(0), 0.0, 5, 12, 1.0, 0, 0, 0.0, 0, 0.0, 0, 0, 1.0, 1.0, "A", ts(0)),
            (2, "E2", "L", "S", "B", "DAY", ts(1), 6.0, 5, 12, 1.01, 0, 0, 0.0, 0, 0.0, 0, 0, 1.0, 1.0, "A", ts(1))]
    df = spark.createDataFrame(rows, S.PRODUCTION_SCHEMA)
    got = sorted((r["entity_id"], r["column"]) for r in q.flatten(q.impossible_production_values(df)).collect())
    assert got == [("1", "cycle_time_sec"), ("2", "station_yield")]


def test_duplicates_report_every_member(spark):
    df = sensor_rows(spark, [{"timestamp": ts(0)}, {"timestamp": ts(0)}, {"timestamp": ts(1)}])
    got = sorted(r["entity_id"] for r in q.duplicate_timestamps(df, ["machine_id", "station_id"], q.SENSOR).collect())
    assert got == ["1", "2"]


def test_gap_threshold_is_strict(spark):
    df = sensor_rows(spark, [{"timestamp": ts(0)}, {"timestamp": ts(30)}, {"timestamp": ts(60, micros=1)}])
    got = q.flatten(q.timestamp_gaps(df, ["machine_id", "station_id"], q.SENSOR, 300, 6)).collect()
    assert [r["entity_id"] for r in got] == ["3"] and got[0]["threshold_seconds"] == 1800.0


def _stuck(spark, values, chunk_rows=1_000_000):
    df = sensor_rows(spark, [{"vibration_rms": v} for v in values])
    return q.flatten(q.stuck_sensor(df, ["vibration_rms"], chunk_rows=chunk_rows)).collect()


def test_run_of_six_equal_values_is_stuck_five_is_not(spark):
    assert _stuck(spark, [1.0, 2.0, 2.0, 2.0, 2.0, 2.0, 3.0]) == []
    got = _stuck(spark, [1.0, 2.0, 2.0, 2.0, 2.0, 2.0, 2.0, 3.0])
    assert len(got) == 1 and got[0]["entity_id"] == "7" and got[0]["example_value"] == 2.0


def test_null_splits_a_run_and_last_stuck_row_wins(spark):
    vals = [5.0] * 6 + [None] + [5.0] * 3 + [7.0] * 7
    got = _stuck(spark, vals)
    assert len(got) == 1 and got[0]["entity_id"] == "17"
    assert _stuck(spark, vals, chunk_rows=5)[0]["entity_id"] == "17"  # smallest legal chunk


def test_dropout_and_delay(spark):
    df = sensor_rows(spark, [
        {c: None for c in ["air_temperature", "process_temperature", "vibration_rms", "vibration_peak", "pressure"]},
        {c: None for c in ["air_temperature", "process_temperature", "vibration_rms", "vibration_peak"]},
        {"created_at": ts(2, seconds=60)}, {"created_at": ts(3, seconds=61)}])
    assert [r["entity_id"] for r in q.sensor_dropout(df).collect()] == ["1"]
    assert [r["entity_id"] for r in q.delayed_readings(df, q.SENSOR).collect()] == ["4"]


def test_missing_values_list_columns(spark):
    df = sensor_rows(spark, [{"pressure": None, "torque": None}, {}])
    got = q.flatten(q.missing_values(df, S.SENSOR_REQUIRED_COLUMNS, q.SENSOR)).collect()
    assert len(got) == 1 and got[0]["missing_columns"] == ["pressure", "torque"]


def test_empty_table_gives_single_issue(spark):
    empty = spark.createDataFrame([], S.SENSOR_SCHEMA)
    got = q.validate_sensor_readings(empty).collect()
    assert [(r["issue_type"], r["entity_type"]) for r in got] == [("empty_table", "sensor_reading")]


def test_missing_required_column(spark):
    df = sensor_rows(spark, [{}]).drop("ambient_humidity")
    got = q.validate_sensor_readings(df).where(F.col("issue_type") == "missing_required_column").collect()
    assert len(got) == 1 and "ambient_humidity" in got[0]["details_json"]
