"""Record contract, quarantine, idempotent append, envelopes."""
import json

from pyspark.sql import functions as F

from conftest import ts
from millwright import schemas as S
from millwright.sources import ingest as ig

VALID = {"event_id": "SENSOR_TEST_001", "machine_id": "MTR_TEST_01", "line_id": "LINE_TEST",
         "station_id": "ST_TEST_01", "timestamp": "2026-05-01T06:00:00Z", "air_temperature": 28.0,
         "vibration_rms": 1.5, "tool_wear": 35.0}


def _lines(spark, objs):
    return spark.createDataFrame([(o if isinstance(o, str) else json.dumps(o),) for o in objs], "value string")


def test_contract_split(spark):
    bad_ts = dict(VALID, timestamp="not-a-date")
    no_machine = {k: v for k, v in VALID.items() if k != "machine_id"}
    valid, bad = ig.parse_records(_lines(spark, [VALID, bad_ts, no_machine, "{broken", "   ", "[1,2]"]),
                                  S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS)
    v = valid.collect()
    assert len(v) == 1 and v[0]["machine_id"] == "MTR_TEST_01" and v[0]["timestamp"] == ts(0)
    reasons = sorted(tuple(r["reject_reasons"]) for r in bad.collect())
    assert reasons == [("invalid_timestamp",), ("malformed_json",), ("malformed_json",), ("missing_machine_id",)]


def test_duplicate_event_id_stored_once(spark):
    rows = [("E1", 1, ts(0), ts(1)), ("E1", 2, ts(0), ts(0)), (None, 3, ts(2), ts(2)), (None, 4, ts(2), ts(2)),
            ("E2", 5, ts(3), ts(3))]
    schema = "event_id string, id long, timestamp timestamp, created_at timestamp"
    incoming = spark.createDataFrame(rows, schema)
    target = spark.createDataFrame([("E2", 9, ts(3), ts(3))], schema)
    got = sorted(((r["event_id"], r["id"]) for r in ig.idempotent_append(target, incoming).collect()),
                 key=lambda x: (x[0] or "", x[1]))
    # first arrival of E1 wins (id 2 arrived first); null ids always insert; E2 already stored
    assert got == [(None, 3), (None, 4), ("E1", 2)]


def test_envelope_roundtrip(spark):
    env = json.dumps({"sensor_readings": [VALID, dict(VALID, event_id="S2")],
                      "production_events": [{"line_id": "L", "station_id": "S", "timestamp": "2026-05-01T06:00:00Z",
                                             "throughput_count": 10}]})
    s, p, counts, bad = ig.unpack_envelopes(spark.createDataFrame([(1, env)], "batch_id long, value string"))
    assert s.count() == 2 and p.count() == 1
    c = counts.first()
    assert (c["sensor_count"], c["production_count"]) == (2, 1)
    assert p.first()["throughput_count"] == 10
    assert bad.count() == 0 and s.first()["created_at"] is not None


def test_bad_envelopes_and_records_are_quarantined(spark):
    rows = [(1, json.dumps({"sensor_readings": [VALID, dict(VALID, machine_id=None, timestamp=None), None, 5]})),
            (2, '{"sensor_readings": [{"mach'), (3, "[]"), (4, "{}"), (5, '{"sensor_readings": 7}'), (6, None)]
    s, p, counts, bad = ig.unpack_envelopes(spark.createDataFrame(rows, "batch_id long, value string"))
    assert s.count() == 1 and p.count() == 0
    assert {r["batch_id"]: (r["sensor_count"], r["rejected_count"]) for r in counts.collect()} == {
        1: (1, 3), 2: (0, 0), 3: (0, 0), 4: (0, 0), 5: (0, 0), 6: (0, 0)}
    got = sorted((r["envelope"]["batch_id"], r["kind"], tuple(r["reject_reasons"])) for r in bad.collect())
    assert (1, "sensor_reading", ("missing_machine_id", "missing_timestamp")) in got
    assert {g[0] for g in got if g[1] == "envelope"} >= {2, 5, 6} and len([g for g in got if g[0] == 1]) == 3


def test_contract_values(spark):
    times = {"2026-05-01": True, "2026-05-01T06:00": True, "2026-05-01 06:00:00.123+02:00": True, 1777615200: True, 1777615200000: True,
             "12:30:00": False, "2024-01": False, "2024": True, "2024-13-01T00:00:00Z": False, "T06:00": False, "": False}
    lines = _lines(spark, [dict(VALID, event_id=str(i), timestamp=t) for i, t in enumerate(times)])
    valid, bad = ig.parse_records(lines, S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS)
    assert {r["event_id"] for r in valid.collect()} == {str(i) for i, ok in enumerate(times.values()) if ok}
    assert all(r["reject_reasons"] == ["invalid_timestamp"] for r in bad.collect())
    records = [dict(VALID, event_id="a", torque="12.5"), dict(VALID, event_id="b", torque="twelve"), dict(VALID, event_id="c", torque="Infinity")]
    valid, bad = ig.parse_records(_lines(spark, records), S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS)
    assert {r["event_id"]: r["torque"] for r in valid.collect()} == {"a": 12.5, "c": None}
    assert [r["reject_reasons"] for r in bad.collect()] == [["invalid_torque"]]
    assert all(r["created_at"] is not None for r in valid.collect())
    prod = {"line_id": "L", "station_id": "S", "timestamp": "2026-05-01T06:00:00Z"}
    valid, bad = ig.parse_records(_lines(spark, [dict(prod, throughput_count=v) for v in (12, "12", 12.0, 12.5)]),
                                  S.PRODUCTION_SCHEMA, ig.PRODUCTION_REQUIRED_FIELDS)
    assert [r["throughput_count"] for r in valid.collect()] == [12, 12, 12] and bad.count() == 1


def test_replaying_twice_stores_once(spark):
    quarantine = spark.createDataFrame([(json.dumps(dict(VALID, event_id=e)),) for e in ("E1", "E1", "E2")] + [("{broken",)], "raw_record string")
    target = spark.createDataFrame([("E2",)], "event_id string")
    rows, still = ig.replay_quarantine(target, quarantine, S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS)
    assert [r["event_id"] for r in rows.collect()] == ["E1"] and still.count() == 1


def test_wide_to_core(spark):
    wide = spark.createDataFrame([("M", "L", "S", ts(0), 10.0, 2.0, "LOT1")],
                                 "machine_id string, line_id string, station_id string, timestamp timestamp, "
                                 "hours_since_maintenance double, machine_age_days double, lot_id string")
    core = ig.wide_sensor_to_core(wide).first()
    assert core["operating_hours"] == 58.0 and core["created_at"] == ts(0)
    prod = ig.wide_production_to_core(wide.withColumn("shift", F.lit("DAY"))).first()
    assert prod["batch_id"] == "LOT1"


def test_unpacked_rows_are_parsed_once(spark):
    """A filter of valid rows is not pushed below the parse, where it would repeat it for every condition."""
    good = '{"sensor_readings":[{"id":1,"machine_id":"M","line_id":"L","station_id":"S","timestamp":"2026-05-01T06:00:00Z"},null],"production_events":[]}'
    envelopes = spark.createDataFrame([(1, good), (2, "{")], "batch_id long, value string")
    sensor, production, counted, bad = ig.unpack_envelopes(envelopes)
    for df in (sensor, production, counted, bad):
        assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [r.id for r in sensor.collect()] == [1] and production.count() == 0
    assert sorted((r.kind, r.raw_record) for r in bad.collect()) == [("envelope", "{"), ("sensor_reading", "null")]
    assert sorted((r.batch_id, r.sensor_count, r.rejected_count) for r in counted.collect()) == [(1, 1, 1), (2, 0, 0)]
