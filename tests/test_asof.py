"""As-of join: backward, tolerance inclusive, ties to the highest sensor id."""
from conftest import ts
from millwright.operators.asof import asof_join

S_SCHEMA = "id long, machine_id string, line_id string, station_id string, timestamp timestamp, vibration_rms double"
P_SCHEMA = "id long, line_id string, station_id string, timestamp timestamp, cycle_time_sec double"


def _join(spark, sensors, events, tol=1800.0):
    s = spark.createDataFrame(sensors, S_SCHEMA)
    p = spark.createDataFrame(events, P_SCHEMA)
    return {r["id_prod"]: r for r in asof_join(s, p, tol).collect()}


def test_future_sensor_not_joined(spark):
    out = _join(spark, [(1, "M1", "L", "S", ts(0), 1.5), (2, "M1", "L", "S", ts(10), 99.0)],
                [(10, "L", "S", ts(5), 6.0)])
    assert len(out) == 1 and out[10]["vibration_rms"] == 1.5 and out[10]["join_lag_seconds"] == 300.0


def test_tolerance_is_inclusive(spark):
    out = _join(spark, [(1, "M1", "L", "S", ts(0), 1.0)],
                [(10, "L", "S", ts(30), 1.0), (11, "L", "S", ts(30, micros=1), 1.0)])
    assert set(out) == {10}


def test_same_timestamp_matches_and_ties_pick_highest_id(spark):
    out = _join(spark, [(1, "M1", "L", "S", ts(5), 1.0), (7, "M2", "L", "S", ts(5), 2.0)],
                [(10, "L", "S", ts(5), 1.0)])
    assert out[10]["id"] == 7 and out[10]["machine_id"] == "M2" and out[10]["join_lag_seconds"] == 0.0


def test_keys_separate_and_nulls_dropped(spark):
    out = _join(spark, [(1, "M1", "L", "A", ts(0), 1.0), (2, "M2", "L", "B", ts(1), 2.0),
                        (3, "M3", None, "A", ts(2), 3.0)],
                [(10, "L", "A", ts(3), 1.0), (11, "L", "B", ts(3), 1.0), (12, None, "A", ts(3), 1.0)])
    assert out[10]["id"] == 1 and out[11]["id"] == 2 and 12 not in out


def test_bucket_boundaries_do_not_change_matches(spark):
    sensors = [(i, f"M{i % 3}", "L", "S", ts(i * 7), float(i)) for i in range(40)]
    events = [(100 + i, "L", "S", ts(i * 5 + 1), 0.0) for i in range(60)]
    matched = 0
    for tol in (59.0, 250.5, 600.0, 100_000.0):
        want = {}
        for e in events:
            near = [s for s in sensors if 0 <= (e[3] - s[4]).total_seconds() <= tol]
            if near:
                want[e[0]] = max(near, key=lambda s: (s[4], s[0]))[0]
        assert {k: v["id"] for k, v in _join(spark, sensors, events, tol=tol).items()} == want
        matched += len(want)
    assert matched > 80


def test_one_full_shuffle_and_no_checkpoint(spark):
    s = spark.createDataFrame([(1, "M1", "L", "S", ts(0), 1.0)], S_SCHEMA)
    p = spark.createDataFrame([(10, "L", "S", ts(1), 1.0)], P_SCHEMA)
    plan = asof_join(s, p)._jdf.queryExecution().executedPlan().toString()
    assert "RDDScan" not in plan and "ExistingRDD[line" not in plan
    assert plan.count("Exchange hashpartitioning") == 3  # the rows, and two small aggregates
    assert "Generate" not in plan  # no reading is copied to several buckets
