"""Stream-stream as-of: out-of-order arrivals, the late gate, and state that is given back."""
from conftest import ts
from millwright.operators.asof import asof_join
from millwright.session import scratch_path
from millwright.streaming import asof_stream, jobs as sj

S_SCHEMA = "id long, machine_id string, line_id string, station_id string, timestamp timestamp, vibration_rms double"
P_SCHEMA = "id long, line_id string, station_id string, timestamp timestamp, cycle_time_sec double"


def _land(spark, path, schema, batches):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.createDataFrame([], schema).schema


def test_equals_the_batch_join_and_a_better_reading_may_come_later(spark):
    land_s, land_p, sink, ck = (scratch_path(spark, n) for n in ("s", "p", "sink", "ck"))
    sensors = [[(1, "M1", "L", "S", ts(0), 1.0), (2, "M1", None, "S", ts(1), 1.5)],
               [(4, "M1", "L", "S", ts(3), 4.0), (3, "M2", "L", "S", ts(3), 3.0), (9, "M1", "L", "S", None, 0.0)],
               [(5, "M1", "L", "T", ts(700), 5.0)], [(6, "M1", "L", "S", ts(1400), 6.0)], [(7, "M1", "L", "S", ts(2100), 7.0)]]
    events = [[(10, "L", "S", ts(2), 0.0), (11, "L", "S", ts(4), 0.0)], [(12, "L", "S", ts(33), 0.0), (13, "L", "S", ts(33, micros=1), 0.0)],
              [(14, "L", "T", ts(701), 0.0), (15, None, "T", ts(701), 0.0)], [(16, "L", "S", ts(1400), 0.0)], [(17, "L", "S", ts(2099), 0.0)]]
    s_type, p_type = _land(spark, land_s, S_SCHEMA, sensors), _land(spark, land_p, P_SCHEMA, events)
    pairs = asof_stream.asof_pairs(sj.read_table_stream(spark, land_s, s_type, 1), sj.read_table_stream(spark, land_p, p_type, 1), 1800.0, "10 minutes")
    query = sj.run_available(pairs.writeStream.foreachBatch(asof_stream.asof_upsert_writer(sink)), ck)
    got = asof_stream.read_asof(spark, sink)
    want = asof_join(spark.createDataFrame(sum(sensors, []), s_type), spark.createDataFrame(sum(events, []), p_type), 1800.0)
    columns = want.columns
    assert set(got.columns) == set(columns)
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.collect()))
    assert {r.id_prod: r.id for r in got.collect()} == {10: 1, 11: 4, 12: 4, 14: 5, 16: 6}
    # rows behind the watermark have left the state
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 6


def test_the_gate_sets_late_rows_aside_and_a_replay_decides_alike(spark):
    on_time, late = (scratch_path(spark, n) for n in ("on", "late"))
    write = asof_stream.late_gate(on_time, late, 600)
    schema = "id long, timestamp timestamp"
    batches = [[(1, ts(0)), (2, ts(-500))], [(3, ts(100)), (4, ts(-10)), (5, ts(-11)), (6, None)], [(7, ts(90)), (8, ts(89))], [(9, None)], [(10, ts(90))]]
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        write(df, k)
        write(df, k)
    assert sorted(r.id for r in spark.read.parquet(on_time).collect()) == [1, 2, 3, 4, 7, 10]
    assert sorted((r.id, r.late_reason) for r in spark.read.parquet(late).collect()) == [(5, "late"), (6, "no_time"), (8, "late"), (9, "no_time")]


def test_dense_readings_make_no_pairs(spark):
    """200 readings and 200 events within the tolerance of one another: each row is handed on twice at most."""
    land_s, land_p, sink, ck = (scratch_path(spark, n) for n in ("s", "p", "sink", "ck"))
    sensors = [(k, "M1", "L", "S", ts(0, k), float(k)) for k in range(200)]
    events = [(k, "L", "S", ts(0, k), 0.0) for k in range(200)]
    s_type, p_type = _land(spark, land_s, S_SCHEMA, [sensors]), _land(spark, land_p, P_SCHEMA, [events])
    pairs = asof_stream.asof_pairs(sj.read_table_stream(spark, land_s, s_type), sj.read_table_stream(spark, land_p, p_type), 1800.0, "10 minutes")
    handed, write = [], asof_stream.asof_upsert_writer(sink)

    def counted(batch, batch_id):
        rows = batch.selectExpr("size(rows) as n") if "rows" in batch.columns else batch.selectExpr("1 as n")
        handed.append(rows.agg({"n": "sum"}).first()[0] or 0)
        write(batch, batch_id)
    sj.run_available(pairs.writeStream.outputMode("update").foreachBatch(counted), ck)
    assert sum(handed) <= 2 * (len(sensors) + len(events))
    assert sorted((r.id_prod, r.id) for r in asof_stream.read_asof(spark, sink).collect()) == [(k, k) for k in range(200)]
