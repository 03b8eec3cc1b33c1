"""Retries, dead letters, counters, commit markers and the id index."""
import json

import pytest
from pyspark.sql import functions as F

from conftest import ts
from millwright import schemas as S
from millwright.operators import scoring
from millwright.session import scratch_path
from millwright.sources import ingest as ig
from millwright.streaming import commits, delivery, idindex, jobs as sj


def _line(event, machine="M1", time="2026-05-01T06:00:00+00:00"):
    return json.dumps({"event_id": event, "machine_id": machine, "line_id": "L", "station_id": "S", "timestamp": time})


def _way(spark, **options):
    way = delivery.Delivery(scratch_path(spark, "way"), S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS, delay_seconds=0.0, **options)
    way.prepare(spark)
    return way


def _totals(spark, way):
    rows = way.table(spark, "counters").groupBy("stream").agg(*[F.sum(c).alias(c) for c in
                                                            ("generated", "sent", "duplicate", "buffered", "retried", "failed")]).collect()
    return {r.stream: tuple(r)[1:] for r in rows if r.stream != "none"}


def test_attempts_until_accepted_or_dead(spark):
    """M1 is taken at once, M2 at the third attempt, M3 never; a broken line never; E1 comes twice."""
    way = _way(spark, max_attempts=4, reachable=(F.col("machine_id") == "M1") | ((F.col("machine_id") == "M2") & (F.col("attempts") >= 2)))
    lines = [_line("E1"), _line("E2", "M2"), _line("E3", "M3"), "{broken", "  ", _line("E1")]
    new = way.first_deliveries(spark.createDataFrame([(x,) for x in lines], "value string"))
    write = way.writer("first")
    write(new, 0)
    write(new, 0)  # the micro-batch again: it replaces itself
    assert way.retry_until_settled(spark, scratch_path(spark, "ck")) >= 3
    assert sorted(r.event_id for r in way.table(spark, "accepted").collect()) == ["E1", "E2"]
    dead = way.table(spark, "dead").collect()
    assert sorted((r.raw_record[:7], r.attempts, r.reject_reasons[0]) for r in dead) == [
        ('{"event', 4, "store_unreachable"), ("{broken", 4, "malformed_json")]
    totals = _totals(spark, way)
    assert totals == {"first": (5, 1, 1, 3, 0, 0), "retry": (0, 1, 0, 5, 8, 2)}
    both = [sum(x) for x in zip(*totals.values())]
    generated, sent, duplicate, buffered, retried, failed = both
    assert generated == sent + duplicate + failed and buffered == retried


def test_a_record_is_not_tried_before_its_time(spark):
    way = _way(spark, max_attempts=3)
    write = way.writer("retry")
    soon = F.current_timestamp() + F.make_dt_interval(hours=F.lit(1))
    batch = spark.createDataFrame([(_line("E9"), 1, None, None)], delivery.PENDING).withColumn("not_before", soon)
    write(batch, 0)
    kept = way.table(spark, "pending").collect()
    assert [(r.attempts, r.stream) for r in kept] == [(1, "retry")] and way.table(spark, "accepted").count() == 0
    write(spark.createDataFrame([(_line("E9"), 1, ts(0), None)], delivery.PENDING), 1)
    assert way.table(spark, "accepted").count() == 1


def test_observed_metrics_become_rows(spark):
    land, sink, ck, out = (scratch_path(spark, n) for n in ("land", "sink", "ck", "metrics"))
    for k in range(2):
        spark.createDataFrame([(_line(f"A{k}"),), ("{",)], "value string").coalesce(1).write.mode("append").text(land)
    listener = delivery.MetricRows(spark, out)
    spark.streams.addListener(listener)
    try:
        rows = sj.with_ingest_metrics(sj.classify_stream(sj.read_json_lines(spark, land, 1)), "ingest")
        sj.run_available(rows.writeStream.queryName("metrics").format("parquet").option("path", sink), ck)
        for _ in range(100):  # progress is told a little later
            if len({r[1] for r in listener.rows}) == 2:
                break
            import time
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    listener.flush()
    got = spark.read.parquet(out).where("metric <> 'latest_event'").groupBy("metric").agg(F.sum(F.col("value").cast("long")).alias("n"))
    assert {r.metric: r.n for r in got.collect()} == {"accepted": 2, "quarantined": 2}


def test_a_batch_shows_all_its_outputs_or_none(spark):
    root = scratch_path(spark, "sinks")
    batch = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")

    def outputs(fail):
        def make(b):
            second = b.select(F.raise_error(F.lit("killed"))) if fail else b.where("id = 2")
            return {"all": b, "some": second}
        return make

    commits.committed_writer(root, outputs(False))(batch, 0)
    with pytest.raises(Exception, match="killed"):
        commits.committed_writer(root, outputs(True))(batch, 1)
    assert spark.read.parquet(f"{root}/all").count() == 4  # written, but not shown
    assert commits.read_committed(spark, root, "all").count() == 2
    commits.committed_writer(root, outputs(False))(batch, 1)
    commits.committed_writer(root, outputs(True))(batch, 1)  # marked: not written again
    assert commits.read_committed(spark, root, "all").count() == 4 and commits.read_committed(spark, root, "some").count() == 2


def test_the_scoring_stream_commits_its_three_outputs(spark):
    root = scratch_path(spark, "scored")
    calls = []
    row = spark.createDataFrame([(1, "M1", "L", "S", ts(0), "critical", True, 10.0, -0.5, "h", "a", 0.0)],
                                "id long, machine_id string, line_id string, station_id string, timestamp timestamp, risk_level string, "
                                "anomaly_flag boolean, health_score double, anomaly_score double, diagnostic_hint string, hint_action string, risk_components double")
    write = sj.score_batch_writer(root, lambda b: calls.append(1) or b)
    write(row, 0)
    assert calls == [1] and scoring.alerts(row).count() == 1
    assert [commits.read_committed(spark, root, n).count() for n in ("predictions", "alerts", "hints")] == [1, 1, 1]


def test_the_index_reads_only_partitions_that_may_hold_an_id(spark):
    index = idindex.IdIndex(scratch_path(spark, "ids"), buckets=4)
    ids = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("E"), "id").alias("event_id"))
    for k in range(5):
        if k == 0:
            assert index.partitions(ids(0, 200), 0) == []
        index.add(ids(k * 200, k * 200 + 200), k)
    new = index.partitions(ids(5000, 5050), 5)
    assert len(new) <= 6  # 20 partitions; one hash in 131,072 bits lets few pass
    again = index.partitions(ids(400, 600), 5)
    assert {(2, b) for b in range(4)} <= set(again) and len(again) <= 4 + 12
    one = index.partitions(ids(450, 451), 5)
    assert len(one) <= 2 and (2, one[0][1]) in one
    files = index.stored(ids(450, 451), 5).inputFiles()
    assert len(files) <= 2 and index.stored(ids(450, 451), 5).where("event_id = 'E450'").count() == 1
    # earlier micro-batches only, so a replay does not meet its own ids
    assert (4, 0) not in index.partitions(ids(800, 1000), 4)


def test_dedupe_with_the_index_forgets_nothing(spark):
    sink, root = scratch_path(spark, "sink"), scratch_path(spark, "ids")
    write = sj.dedupe_writer(sink, arrival=["id"], index=idindex.IdIndex(root, buckets=2))
    batches = [[("E1", 1), (None, 2)], [("E1", 3), ("E2", 4)], [("E2", 5), (None, 6), ("E3", 7)]]
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "event_id string, id long")
        write(df, k)
        write(df, k)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [1, 2, 4, 6, 7]
