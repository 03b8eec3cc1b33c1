"""Registered streaming queries (ST-1..10).

Each query lands fixture-derived files in a fresh folder under the session's
``spark.checkpoint.dir``, runs the streaming job with ``availableNow`` and a
checkpoint, and returns the sink read back as a batch DataFrame.  Their oracle
is the batch SQL of the same operator: a stream must produce what the batch
path produces.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..session import scratch_path
from ..sources import ingest as ig
from ..streaming import asof_stream, commits, delivery, idindex, jobs as sj, monitor
from . import tables as t
from .catalog import register
from .queries_ingest import BAD_TS_MOD, NO_MACHINE_MOD, TRUNCATED_MOD, damaged_sensor_lines
from .queries_core import ASOF_COLUMNS, ASOF_TOLERANCE_SECONDS
from .queries_quality import (GAP_INTERVAL_SECONDS, SENSOR_ID, _STUCK_QUERY, _S_RULES, _head,
                              sql_delay, sql_missing, sql_values)
from .queries_readmodels import SCORED_CTES
from .sqlfrag import ASOF_CTES

DELIVERY_SECONDS = 7 * 86_400


def _deliveries(df, name: str):
    """The rows cut into weekly deliveries, oldest first; rows without a time come last, in one of their own.

    The table is written once, partitioned by delivery, so landing a delivery
    reads that delivery alone.  Which weeks there are comes from the data.
    """
    spark = df.sparkSession
    week = F.coalesce(F.floor(F.unix_micros("timestamp") / (DELIVERY_SECONDS * 1_000_000)).cast("long"), F.lit(2**40))
    staged = scratch_path(spark, name)
    df.withColumn("delivery", week).write.partitionBy("delivery").parquet(staged)
    table = spark.read.schema(df.schema.add("delivery", "long") if "delivery" not in df.columns else df.schema).parquet(staged)
    for r in table.select("delivery").distinct().orderBy("delivery").collect():  # one row for each week
        yield table.where(F.col("delivery") == r.delivery).drop("delivery")


def _land_weekly(df, path: str, fmt: str = "json", repeat: int = 1) -> int:
    """Land ``df`` as one delivery per week, oldest first (``repeat`` = re-deliveries).

    Returns the number of files per delivery, used as ``maxFilesPerTrigger`` so
    that a micro-batch is about one delivery.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    for week in _deliveries(df, "deliveries"):
        for _ in range(repeat):
            part = week.repartition(n, "machine_id") if "machine_id" in df.columns else week.repartition(n)
            w = part.write.mode("append")
            (w.json(path) if fmt == "json" else w.parquet(path))
    return n


def _land_lines(df, path: str) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    for week in _deliveries(df, "deliveries"):
        ig.to_json_lines(week, keep=[]).repartition(n).write.mode("append").text(path)
    return n


@register("stream_dedupe", sql="""
SELECT DISTINCT event_id, id, machine_id, "timestamp" FROM sensor_readings
""")
def q_stream_dedupe(spark, sf):
    """ST-1/2: every weekly delivery arrives twice; duplicate event ids are dropped in-stream."""
    land, sink, ck = (scratch_path(spark, n) for n in ("landing", "sink", "ckpt"))
    files = _land_weekly(t.sensor(spark, sf), land, fmt="parquet", repeat=2)
    stream = sj.read_table_stream(spark, land, S.SENSOR_SCHEMA, max_files=files)
    index = idindex.IdIndex(scratch_path(spark, "ids"))
    sj.run_available(stream.writeStream.foreachBatch(sj.dedupe_writer(sink, arrival=["created_at", "id"], index=index)), ck)
    return spark.read.parquet(sink).select("event_id", "id", "machine_id", "timestamp")


@register("stream_per_minute", sql="""
SELECT date_trunc('minute', "timestamp") AS minute, stream_type, count(*) AS records
FROM (SELECT "timestamp", 'sensor' AS stream_type FROM sensor_readings
      UNION ALL SELECT "timestamp", 'production' AS stream_type FROM production_events)
GROUP BY 1, 2
""")
def q_stream_per_minute(spark, sf):
    """ST-3: per-minute ingest counts on event time; micro-batches' counts add up, however late a row is."""
    land, sink, ck = (scratch_path(spark, n) for n in ("landing", "sink", "ckpt"))
    both = (t.sensor(spark, sf).select("timestamp", F.lit("sensor").alias("stream_type"))
            .unionByName(t.production(spark, sf).select("timestamp", F.lit("production").alias("stream_type"))))
    files = _land_weekly(both, land, fmt="parquet")
    schema = "timestamp timestamp, stream_type string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).parquet(land)
    sj.run_available(stream.writeStream.foreachBatch(sj.minute_counts_writer(sink)), ck)
    return sj.summed_counts(spark, sink)


_STREAM_DQ_SQL = "\nUNION ALL\n".join([
    sql_missing("sensor_readings", S.SENSOR_REQUIRED_COLUMNS, "sensor_reading"),
    sql_values("sensor_readings", _S_RULES, "sensor_reading"),
    f"SELECT {_head('sensor_dropout', 'high', 'sensor_reading')}, {SENSOR_ID} FROM sensor_readings WHERE ("
    + " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in
                 ["air_temperature", "process_temperature", "vibration_rms", "vibration_peak", "pressure",
                  "torque", "rotational_speed", "motor_current", "power_consumption"]) + ") >= 5",
    sql_delay("sensor_readings", "sensor_reading"),
])


@register("stream_dq", sql=f"SELECT * FROM ({_STREAM_DQ_SQL})")
def q_stream_dq(spark, sf):
    """ST-1/4/5/9/10: JSON lines parsed on arrival, stateless rules applied, issues appended."""
    land, sink, quarantine, ck = (scratch_path(spark, n) for n in ("landing", "sink", "quarantine", "ckpt"))
    files = _land_lines(t.sensor(spark, sf), land)
    lines = sj.read_json_lines(spark, land, max_files=files)
    classified = sj.with_ingest_metrics(sj.classify_stream(lines))
    sj.run_available(classified.writeStream.foreachBatch(sj.quality_and_quarantine_writer(sink, quarantine)), ck)
    return spark.read.parquet(sink).select("issue_type", "severity", "entity_type", "entity_id", "machine_id",
                                           "line_id", "station_id", "timestamp")


_GAP_S = GAP_INTERVAL_SECONDS * 6


@register("stream_gap_stuck", sql=f"""
SELECT 'gap' AS kind, machine_id, station_id, id, "timestamp", NULL AS "column", round(gap, 6) AS value
FROM (SELECT *, (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (
        PARTITION BY machine_id, station_id ORDER BY "timestamp", id))) / 1e6 AS gap FROM sensor_readings)
WHERE gap > {_GAP_S}
UNION ALL
SELECT 'stuck', machine_id, station_id, CAST(entity_id AS BIGINT), "timestamp", "column", example_value
FROM ({_STUCK_QUERY})
""")
def q_stream_gap_stuck(spark, sf):
    """ST-6: gaps and flatlines per machine from keyed state (applyInPandasWithState)."""
    land, sink, ck = (scratch_path(spark, n) for n in ("landing", "sink", "ckpt"))
    files = _land_weekly(t.sensor(spark, sf), land, fmt="parquet")
    stream = sj.read_table_stream(spark, land, S.SENSOR_SCHEMA, max_files=files)
    mon = sj.gap_stuck_monitor(stream, float(_GAP_S))
    sj.run_available(mon.writeStream.format("parquet").option("path", sink), ck)
    rows = spark.read.parquet(sink)
    gaps = rows.where(F.col("kind") == "gap").select("kind", "machine_id", "station_id", "id", "timestamp",
                                                     "column", "value")
    stuck = sj.stuck_report(rows).select(F.lit("stuck").alias("kind"), "machine_id", "station_id", "id",
                                         "timestamp", "column", "value")
    return gaps.unionByName(stuck)


@register("stream_asof", sql=f"""
SELECT id_prod, event_id_prod, line_id, station_id, "timestamp", id, machine_id, sensor_timestamp,
       round(join_lag_seconds, 6) AS join_lag_seconds, round(vibration_rms, 6) AS vibration_rms,
       round(tool_wear, 6) AS tool_wear, round(cycle_time_sec, 6) AS cycle_time_sec
FROM joined
""", extra_ctes=ASOF_CTES)
def q_stream_asof(spark, sf):
    """ST-7: each micro-batch of production events enriched against the landed sensor table."""
    land_s, land_p, sink, ck = (scratch_path(spark, n) for n in ("sensor", "production", "sink", "ckpt"))
    t.sensor(spark, sf).withColumn("reading_date", F.to_date("timestamp")).write.partitionBy("reading_date").parquet(land_s)
    sensor_table = spark.read.parquet(land_s)
    files = _land_weekly(t.production(spark, sf), land_p, fmt="parquet")
    stream = sj.read_table_stream(spark, land_p, S.PRODUCTION_SCHEMA, max_files=files)
    writer = stream.writeStream.foreachBatch(sj.asof_batch_writer(sensor_table, sink, ASOF_TOLERANCE_SECONDS))
    sj.run_available(writer, ck)
    return spark.read.parquet(sink).select(*ASOF_COLUMNS)


@register("stream_asof_join", sql="""
SELECT id_prod, event_id_prod, line_id, station_id, "timestamp", id, machine_id, sensor_timestamp,
       round(join_lag_seconds, 6) AS join_lag_seconds, round(vibration_rms, 6) AS vibration_rms,
       round(tool_wear, 6) AS tool_wear, round(cycle_time_sec, 6) AS cycle_time_sec
FROM joined
""", extra_ctes=ASOF_CTES)
def q_stream_asof_join(spark, sf):
    """ST-7: readings and events both arrive as streams; each event takes the latest reading before it."""
    land_s, land_p, sink, ck = (scratch_path(spark, n) for n in ("sensor", "production", "sink", "ckpt"))
    files_s = _land_weekly(t.sensor(spark, sf), land_s, fmt="parquet")
    files_p = _land_weekly(t.production(spark, sf), land_p, fmt="parquet")
    # a delivery is out of order by its own length
    pairs = asof_stream.asof_pairs(sj.read_table_stream(spark, land_s, S.SENSOR_SCHEMA, max_files=files_s),
                                   sj.read_table_stream(spark, land_p, S.PRODUCTION_SCHEMA, max_files=files_p),
                                   ASOF_TOLERANCE_SECONDS, f"{DELIVERY_SECONDS} seconds")
    sj.run_available(pairs.writeStream.outputMode("update").foreachBatch(asof_stream.asof_upsert_writer(sink)), ck)
    return asof_stream.read_asof(spark, sink).select(*ASOF_COLUMNS)


_LATE_S = 14 * 86_400


@register("stream_late_rows", sql=f"""
SELECT late_reason, count(*) AS deliveries, count(DISTINCT id) AS readings, min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp
FROM (SELECT id, "timestamp", NULL AS late_reason FROM sensor_readings
      UNION ALL SELECT id, "timestamp", CASE WHEN "timestamp" < (SELECT max("timestamp") FROM sensor_readings) - INTERVAL {_LATE_S} SECOND
                                             THEN 'late' END FROM sensor_readings)
GROUP BY late_reason
""")
def q_stream_late_rows(spark, sf):
    """ST-7: all deliveries come a second time after the last one; readings over two weeks old are set aside as late."""
    land, on_time, late, ck = (scratch_path(spark, n) for n in ("landing", "ontime", "late", "ckpt"))
    readings = t.sensor(spark, sf)
    _land_weekly(readings, land, fmt="parquet")
    files = len(spark.read.parquet(land).inputFiles())
    readings.write.mode("append").parquet(land)
    stream = sj.read_table_stream(spark, land, S.SENSOR_SCHEMA, max_files=files)
    sj.run_available(stream.writeStream.foreachBatch(asof_stream.late_gate(on_time, late, _LATE_S)), ck)
    both = spark.read.parquet(late).unionByName(spark.read.parquet(on_time).withColumn("late_reason", F.lit(None).cast("string")))
    return both.groupBy("late_reason").agg(
        F.count("*").alias("deliveries"), F.countDistinct("id").alias("readings"), F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"))


@register("stream_silent", sql=f"""
SELECT 'gap' AS kind, machine_id, station_id, id, "timestamp", NULL AS "column", round(gap, 6) AS value
FROM (SELECT *, (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (
        PARTITION BY machine_id, station_id ORDER BY "timestamp", id))) / 1e6 AS gap FROM sensor_readings)
WHERE gap > {_GAP_S}
UNION ALL
SELECT 'silent', machine_id, station_id, id, "timestamp", NULL, {float(_GAP_S)}
FROM (SELECT *, (epoch_us(lead("timestamp") OVER (PARTITION BY machine_id, station_id ORDER BY "timestamp", id))
                 - epoch_us("timestamp")) / 1e6 AS gap FROM sensor_readings)
WHERE gap > {_GAP_S} OR gap IS NULL
UNION ALL
SELECT 'stuck', machine_id, station_id, CAST(entity_id AS BIGINT), "timestamp", "column", example_value
FROM ({_STUCK_QUERY})
""")
def q_stream_silent(spark, sf):
    """ST-6: gaps, flatlines and silent machines in event-time order, the last by timers; a heartbeat moves time on at the end."""
    land, sink, ck = (scratch_path(spark, n) for n in ("landing", "sink", "ckpt"))
    readings = t.sensor(spark, sf)
    files = _land_weekly(readings, land, fmt="parquet")
    after = F.make_dt_interval(secs=F.lit(float(2 * DELIVERY_SECONDS + _GAP_S)))
    readings.agg((F.max("timestamp") + after).alias("timestamp")).select(
        F.lit("heartbeat").alias("machine_id"), F.lit("").alias("station_id"), F.lit(-1).cast("long").alias("id"), "timestamp",
    ).write.mode("append").parquet(land)
    monitor.use_rocksdb(spark)
    stream = sj.read_table_stream(spark, land, S.SENSOR_SCHEMA, max_files=files)
    rows = monitor.machine_monitor(stream, float(_GAP_S), f"{DELIVERY_SECONDS} seconds")
    sj.run_available(rows.writeStream.format("parquet").option("path", sink), ck)
    out = spark.read.parquet(sink).where("machine_id <> 'heartbeat'")
    events = out.where(F.col("kind").isin("gap", "silent"))
    stuck = sj.stuck_report(out).withColumn("kind", F.lit("stuck"))
    names = ["kind", "machine_id", "station_id", "id", "timestamp", "column", "value"]
    return events.select(*names).unionByName(stuck.select(*names))


@register("stream_score", sql="SELECT * REPLACE ('stream_scoring' AS source) FROM alerts", extra_ctes=SCORED_CTES)
def q_stream_score(spark, sf):
    """ST-8: score arriving prediction rows; predictions, alerts and hints appended per batch."""
    land, root, ck = (scratch_path(spark, n) for n in ("landing", "sinks", "ckpt"))
    preds = t.predictions(spark, sf)
    files = _land_weekly(preds, land, fmt="parquet")
    stream = sj.read_table_stream(spark, land, preds.schema, max_files=files)
    sj.run_available(stream.writeStream.foreachBatch(sj.score_batch_writer(root)), ck)
    return commits.read_committed(spark, root, "alerts")


_MENDED = f"id % {BAD_TS_MOD} = 0 AND id % {TRUNCATED_MOD} <> 0 AND id % {NO_MACHINE_MOD} <> 0"
_DEAD = f"(id % {TRUNCATED_MOD} = 0 OR id % {NO_MACHINE_MOD} = 0)"


@register("stream_retry", sql=f"""
SELECT count(*) AS generated, count(*) FILTER (WHERE NOT {_DEAD}) AS sent, 0 AS duplicate,
       count(*) FILTER (WHERE {_MENDED}) + 2 * count(*) FILTER (WHERE {_DEAD}) AS buffered,
       count(*) FILTER (WHERE {_MENDED}) + 2 * count(*) FILTER (WHERE {_DEAD}) AS retried,
       count(*) FILTER (WHERE {_DEAD}) AS failed, count(*) FILTER (WHERE NOT {_DEAD}) AS accepted_rows,
       count(*) FILTER (WHERE {_DEAD}) AS dead_rows, CASE WHEN bool_or({_DEAD}) THEN 3 END AS dead_attempts
FROM sensor_readings
""")
def q_stream_retry(spark, sf):
    """ST-9/10: damaged lines are buffered and tried again, mended the second time; three attempts, then the dead-letter table."""
    land, root, ck, ck_retry = (scratch_path(spark, n) for n in ("landing", "delivery", "ckpt", "ckpt-retry"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    # as spilled: the record, and the time that the collector's log has for it
    log = t.sensor(spark, sf).select(F.col("id").alias("line_source_id"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("time"))
    lines = damaged_sensor_lines(spark, sf).join(log, "line_source_id", "left")
    lines.select(F.concat_ws("\t", "value", "time").alias("value")).repartition(2 * n).write.text(land)
    parts = F.split("raw_record", "\t")
    mended = F.regexp_replace(parts[0], F.lit('"timestamp":"not-a-date"'), F.concat(F.lit('"timestamp":"'), F.get(parts, F.lit(1)), F.lit('"')))
    way = delivery.Delivery(root, S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS, max_attempts=3, delay_seconds=0.0,
                            mend=F.when(F.col("attempts") > 0, mended).otherwise(parts[0]))
    way.prepare(spark)
    source = way.first_deliveries(spark.readStream.option("maxFilesPerTrigger", str(n)).text(land))
    sj.run_available(source.writeStream.foreachBatch(way.writer("first")), ck)
    way.retry_until_settled(spark, ck_retry)
    sums = way.table(spark, "counters").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in
                                              ("generated", "sent", "duplicate", "buffered", "retried", "failed")])
    accepted = way.table(spark, "accepted").agg(F.count("*").alias("accepted_rows"))
    dead = way.table(spark, "dead").agg(F.count("*").alias("dead_rows"), F.max("attempts").alias("dead_attempts"))
    one = F.lit(1).alias("_k")  # three one-row tables
    return sums.select("*", one).join(accepted.select("*", one), "_k").join(dead.select("*", one), "_k").drop("_k")
