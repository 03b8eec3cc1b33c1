"""Streaming dedupe: re-deliveries of an event id are dropped across micro-batches; null ids all pass."""
from millwright.session import scratch_path
from millwright.streaming import jobs as sj

from conftest import ts

SCHEMA = "event_id string, id long, timestamp timestamp"


def test_dedupe_stream_keeps_first_and_null_ids(spark):
    land, sink, ck = (scratch_path(spark, n) for n in ("land", "sink", "ck"))
    first = [("E1", 1, ts(0)), ("E2", 2, ts(1)), (None, 3, ts(2))]
    again = [("E1", 11, ts(0)), (None, 13, ts(2)), ("E3", 14, ts(3))]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.parquet(land, mode="append")
    spark.createDataFrame(again, SCHEMA).coalesce(1).write.parquet(land, mode="append")
    stream = sj.read_table_stream(spark, land, spark.createDataFrame([], SCHEMA).schema, max_files=1)
    sj.run_available(sj.dedupe_stream(stream).writeStream.format("parquet").option("path", sink), ck)
    got = sorted(((r["event_id"] or ""), r["id"]) for r in spark.read.parquet(sink).collect())
    assert got == [("", 3), ("", 13), ("E1", 1), ("E2", 2), ("E3", 14)]


def test_dedupe_writer_forgets_no_id_and_a_replay_adds_nothing(spark):
    from pyspark.sql import functions as F

    sink = scratch_path(spark, "sink")
    write = sj.dedupe_writer(sink, arrival=["id"])
    batches = [[("E1", 1, ts(0)), (None, 2, None)], [("E1", 3, ts(60 * 24 * 400)), ("E2", 4, None)], [("E2", 5, ts(0)), (None, 6, ts(1))]]
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, SCHEMA)
        write(df, k)
        write(df, k)  # the micro-batch again, as after a failure
    got = sorted(((r["event_id"] or ""), r["id"]) for r in spark.read.parquet(sink).collect())
    assert got == [("", 2), ("", 6), ("E1", 1), ("E2", 4)]
    assert spark.read.parquet(sink).where(F.col("batch_id") == 1).count() == 1


def test_a_stream_that_is_not_done_in_time_is_an_error(spark):
    import pytest

    land, ck = (scratch_path(spark, n) for n in ("land", "ck"))
    spark.createDataFrame([("E1", 1, ts(0))], SCHEMA).write.parquet(land)
    stream = sj.read_table_stream(spark, land, spark.createDataFrame([], SCHEMA).schema)

    def slow(batch, batch_id):
        import time

        time.sleep(20)

    with pytest.raises(TimeoutError):
        sj.run_available(stream.writeStream.foreachBatch(slow), ck, timeout_s=1)
    assert not spark.streams.active


def test_deliveries_cover_all_rows(spark):
    from millwright.plans import queries_stream as qs

    rows = [("a", 1, ts(0)), ("b", 2, ts(60 * 24 * 9)), ("c", 3, ts(-60 * 24 * 4000)), ("d", 4, None)]
    parts = [[r["event_id"] for r in d.collect()] for d in qs._deliveries(spark.createDataFrame(rows, SCHEMA), "d")]
    assert parts == [["c"], ["a"], ["b"], ["d"]]
