"""Registered ingest queries (SRC-4..7, SRC-9) and their oracles.

The inputs are derived from the fixture tables by Spark: rows are serialised
to JSON lines and a deterministic share of them is damaged the way a
collector's spill file gets damaged (missing field, bad timestamp, truncated
line, blank line).  The operators under test then parse the text back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..session import cut_lineage
from ..sources import ingest as ig
from . import tables as t
from .catalog import register

# Deterministic damage pattern of the derived spill file (by source row id).
NO_MACHINE_MOD, BAD_TS_MOD, TRUNCATED_MOD, BLANK_MOD = 59, 53, 61, 47


def damaged_sensor_lines(spark, sf):
    """JSON lines of the sensor table with a deterministic share damaged (one projection)."""
    s = t.sensor(spark, sf)
    i = F.col("id")
    src = s.withColumn("machine_id", F.when(i % NO_MACHINE_MOD == 0, F.lit(None)).otherwise(F.col("machine_id")))
    text = ig.to_json_lines(src).select("value", "id")
    value = (F.when(F.col("id") % TRUNCATED_MOD == 0, F.expr("substring(value, 1, 40)"))
              .when(F.col("id") % BAD_TS_MOD == 0,
                    F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"not-a-date"'))
              .otherwise(F.col("value")))
    lines = text.select(value.alias("value"), F.col("id").alias("line_source_id"))
    blanks = s.where(i % BLANK_MOD == 0).select(F.lit("   ").alias("value"), i.alias("line_source_id"))
    return lines.unionByName(blanks)


@register("ingest_split", sql=f"""
SELECT id AS line_source_id,
       CASE WHEN id % {TRUNCATED_MOD} = 0 OR id % {NO_MACHINE_MOD} = 0 OR id % {BAD_TS_MOD} = 0
            THEN 'rejected' ELSE 'valid' END AS status,
       CASE WHEN id % {TRUNCATED_MOD} = 0 THEN 'malformed_json'
            ELSE concat_ws(',', CASE WHEN id % {NO_MACHINE_MOD} = 0 THEN 'missing_machine_id' END,
                                CASE WHEN id % {BAD_TS_MOD} = 0 THEN 'invalid_timestamp' END) END AS reasons,
       CASE WHEN id % {TRUNCATED_MOD} = 0 OR id % {NO_MACHINE_MOD} = 0 OR id % {BAD_TS_MOD} = 0
            THEN NULL ELSE "timestamp" END AS "timestamp",
       CASE WHEN id % {TRUNCATED_MOD} = 0 OR id % {NO_MACHINE_MOD} = 0 OR id % {BAD_TS_MOD} = 0
            THEN NULL ELSE round(vibration_rms, 6) END AS vibration_rms
FROM sensor_readings
""")
def q_ingest_split(spark, sf):
    """SRC-4/7: JSON lines -> typed valid rows + quarantine with reasons; blank lines dropped."""
    c = ig.classify_records(damaged_sensor_lines(spark, sf), S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS)
    ok = F.col("is_valid")
    return c.select(
        "line_source_id", F.when(ok, F.lit("valid")).otherwise(F.lit("rejected")).alias("status"),
        F.array_join("reject_reasons", ",").alias("reasons"),
        F.when(ok, F.col("timestamp")).alias("timestamp"), F.when(ok, F.col("vibration_rms")).alias("vibration_rms"))


_DEDUPE_CTES = """
target AS (SELECT * FROM sensor_readings WHERE "timestamp" < TIMESTAMP '2024-01-15'),
incoming AS (
  SELECT * REPLACE (2 * id AS id) FROM sensor_readings WHERE "timestamp" >= TIMESTAMP '2024-01-10'
  UNION ALL
  SELECT * REPLACE (2 * id + 1 AS id, created_at + INTERVAL 1 HOUR AS created_at)
  FROM sensor_readings WHERE "timestamp" >= TIMESTAMP '2024-01-10'
),
first_w AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
            ORDER BY created_at, id) AS rn FROM incoming WHERE event_id IS NOT NULL) WHERE rn = 1)
"""


@register("ingest_dedupe", sql="""
SELECT event_id, id, "timestamp", created_at FROM first_w
WHERE event_id NOT IN (SELECT event_id FROM target WHERE event_id IS NOT NULL)
""", extra_ctes=_DEDUPE_CTES)
def q_ingest_dedupe(spark, sf):
    """SRC-6/JN-4: a batch delivered twice (retry) appended idempotently to an overlapping table."""
    s = t.sensor(spark, sf)
    target = s.where(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp"))
    fresh = s.where(F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp"))
    # even ids for the first delivery, odd ones for the second: no two rows share one
    resent = (fresh
              .withColumn("id", 2 * F.col("id") + 1)
              .withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 HOUR")))
    out = ig.idempotent_append(target, fresh.withColumn("id", 2 * F.col("id")).unionByName(resent))
    return out.select("event_id", "id", "timestamp", "created_at")


@register("batch_envelope", sql="""
SELECT 'sensor' AS kind, id, "timestamp", round(vibration_rms, 6) AS value FROM sensor_readings
UNION ALL
SELECT 'production', id, "timestamp", round(cycle_time_sec, 6) FROM production_events
""")
def q_batch_envelope(spark, sf):
    """SRC-5: rows packed into envelopes of at most 100 ids, then unpacked into two tables."""
    s, p = t.sensor(spark, sf), t.production(spark, sf)
    env = ig.pack_envelopes(s, p, F.floor(F.col("id") / 100))
    sens, prod, _counts, _bad = ig.unpack_envelopes(env)
    return (sens.select(F.lit("sensor").alias("kind"), "id", "timestamp", F.col("vibration_rms").alias("value"))
            .unionByName(prod.select(F.lit("production").alias("kind"), "id", "timestamp",
                                     F.col("cycle_time_sec").alias("value"))))


CUT_ENVELOPE_MOD = 7


@register("envelope_quarantine", sql=f"""
SELECT 'sensor_reading' AS kind, id AS ref,
       CASE WHEN id % {NO_MACHINE_MOD} = 0 OR id % {BAD_TS_MOD} = 0 THEN 'rejected' ELSE 'valid' END AS status,
       concat_ws(',', CASE WHEN id % {NO_MACHINE_MOD} = 0 THEN 'missing_machine_id' END,
                      CASE WHEN id % {BAD_TS_MOD} = 0 THEN 'invalid_timestamp' END) AS reasons
FROM sensor_readings WHERE CAST(floor(id / 100.0) AS BIGINT) % {CUT_ENVELOPE_MOD} <> 0
UNION ALL
SELECT 'production_event', id, 'valid', '' FROM production_events WHERE CAST(floor(id / 100.0) AS BIGINT) % {CUT_ENVELOPE_MOD} <> 0
UNION ALL
SELECT DISTINCT 'envelope', CAST(floor(id / 100.0) AS BIGINT), 'rejected', 'malformed_envelope'
FROM (SELECT id FROM sensor_readings UNION ALL SELECT id FROM production_events)
WHERE CAST(floor(id / 100.0) AS BIGINT) % {CUT_ENVELOPE_MOD} = 0
""")
def q_envelope_quarantine(spark, sf):
    """SRC-5/7: envelopes with damaged records, and envelopes cut short: good records, and all that is rejected."""
    i = F.col("id")
    s = t.sensor(spark, sf).withColumn("machine_id", F.when(i % NO_MACHINE_MOD != 0, F.col("machine_id")))
    env = ig.pack_envelopes(s, t.production(spark, sf), F.floor(i / 100))
    # a time of day alone is no timestamp; the damaged records are told by their id
    bad_time = F.expr(f"""to_json(transform(from_json(value, 'sensor_readings array<string>').sensor_readings, r ->
        if(cast(get_json_object(r, '$.id') as bigint) % {BAD_TS_MOD} = 0,
           regexp_replace(r, '"timestamp":"[^"]*"', '"timestamp":"12:30:00"'), r)))""")
    texts = env.select("batch_id", F.expr("get_json_object(value, '$.production_events')").alias("p"), F.from_json(
        bad_time, "array<string>").alias("s"))
    value = F.concat(F.lit('{"sensor_readings":['), F.coalesce(F.array_join("s", ","), F.lit("")),
                     F.lit('],"production_events":'), F.coalesce("p", F.lit("[]")), F.lit("}"))
    cut = F.when(F.col("batch_id") % CUT_ENVELOPE_MOD == 0, F.substring("value", 1, 30)).otherwise(F.col("value"))
    env = texts.select("batch_id", value.alias("value")).select("batch_id", cut.alias("value"))
    sensor, production, bad = ig.classify_envelopes(env)

    def told(df, kind):
        status = F.when(F.col("is_valid"), F.lit("valid")).otherwise(F.lit("rejected")).alias("status")
        return df.select(F.lit(kind).alias("kind"), F.col("id").alias("ref"), status, F.array_join("reject_reasons", ",").alias("reasons"))

    return told(sensor, "sensor_reading").unionByName(told(production, "production_event")).unionByName(
        bad.select(F.lit("envelope").alias("kind"), F.col("envelope.batch_id").alias("ref"), F.lit("rejected").alias("status"),
                   F.array_join("reject_reasons", ",").alias("reasons")))


@register("replay_spill", sql=f"""
SELECT event_id, id, "timestamp" FROM sensor_readings
WHERE id % {BAD_TS_MOD} = 0 AND id % {TRUNCATED_MOD} <> 0 AND id % {NO_MACHINE_MOD} <> 0 AND id % 2 <> 0
""")
def q_replay_spill(spark, sf):
    """SRC-7/ST-10: quarantined records mended and replayed twice into a table that holds some of them already."""
    lines = cut_lineage(damaged_sensor_lines(spark, sf))  # as landed: the text is a column, not how it was made
    s = t.sensor(spark, sf)
    parsed = cut_lineage(ig.classify_records(lines, S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS))
    quarantine = parsed.where("not is_valid")
    # the collector's log has the right time of each record
    known = s.select(F.col("id").alias("line_source_id"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("time"))
    spilled = quarantine.join(known, "line_source_id").select("time", "raw_record")
    twice = spilled.unionByName(spilled)
    mend = F.regexp_replace("raw_record", F.lit('"timestamp":"not-a-date"'), F.concat(F.lit('"timestamp":"'), "time", F.lit('"')))
    appended, _ = ig.replay_quarantine(s.where(F.col("id") % 2 == 0), twice, S.SENSOR_SCHEMA, ig.SENSOR_REQUIRED_FIELDS, mend)
    return appended.select("event_id", "id", "timestamp")


@register("wide_production", sql="""
SELECT id, event_id, line_id, station_id, batch_id, shift, "timestamp", round(cycle_time_sec, 6) AS cycle_time_sec,
       throughput_count, "timestamp" AS created_at FROM production_events
""")
def q_wide_production(spark, sf):
    """SRC-9: wide production rows (lot for batch) mapped to the core production schema."""
    wide = t.production(spark, sf).withColumnRenamed("batch_id", "lot_id").drop("created_at").withColumn("recipe_id", F.lit("R1"))
    return ig.wide_production_to_core(wide).select("id", "event_id", "line_id", "station_id", "batch_id", "shift", "timestamp",
                                                   "cycle_time_sec", "throughput_count", "created_at")


@register("wide_maintenance", sql="""
SELECT id, machine_id, line_id, station_id, "timestamp", 'inspection' AS event_type,
       concat('{"technician":"T', CAST(id % 7 AS VARCHAR), '","minutes":', CAST(id % 90 AS VARCHAR), '}') AS details_json
FROM sensor_readings WHERE tool_wear > 100.0
""")
def q_wide_maintenance(spark, sf):
    """SRC-9: wide maintenance rows (one for each worn-out reading) mapped to events with JSON details."""
    s = t.sensor(spark, sf).where(F.col("tool_wear") > 100.0)
    i = F.col("id")
    wide = s.select("id", "machine_id", "line_id", "station_id", "timestamp", F.lit("Inspection").alias("maintenance_type"),
                    F.concat(F.lit("T"), (i % 7).cast("string")).alias("technician"), (i % 90).alias("minutes"))
    return ig.wide_maintenance_to_events(wide)


@register("wide_to_core", sql="""
SELECT id, machine_id, "timestamp", round(operating_hours / 2.0 + (id % 30) * 24.0, 6) AS operating_hours,
       "timestamp" AS created_at
FROM sensor_readings
""")
def q_wide_to_core(spark, sf):
    """SRC-9: wide generator rows (maintenance age split out) mapped to the core sensor schema."""
    s = t.sensor(spark, sf)
    wide = (s.withColumn("hours_since_maintenance", F.col("operating_hours") / 2.0)
            .withColumn("machine_age_days", (F.col("id") % 30).cast("double"))
            .drop("operating_hours", "created_at"))
    core = ig.wide_sensor_to_core(wide)
    return core.select("id", "machine_id", "timestamp", "operating_hours", "created_at")


def damaged_production_lines(spark, sf):
    """JSON lines of production events; a deterministic share damaged (one projection)."""
    p = t.production(spark, sf)
    i = F.col("id")
    src = p.withColumn("station_id", F.when(i % NO_MACHINE_MOD == 0, F.lit(None)).otherwise(F.col("station_id")))
    text = ig.to_json_lines(src).select("value", "id")
    value = (F.when(F.col("id") % TRUNCATED_MOD == 0, F.expr("substring(value, 1, 40)"))
              .when(F.col("id") % BAD_TS_MOD == 0,
                    F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"2024-13-45T99:00:00Z"'))
              .otherwise(F.col("value")))
    return text.select(value.alias("value"), F.col("id").alias("line_source_id"))


@register("ingest_split_production", sql=f"""
SELECT id AS line_source_id,
       CASE WHEN id % {TRUNCATED_MOD} = 0 OR id % {NO_MACHINE_MOD} = 0 OR id % {BAD_TS_MOD} = 0
            THEN 'rejected' ELSE 'valid' END AS status,
       CASE WHEN id % {TRUNCATED_MOD} = 0 THEN 'malformed_json'
            ELSE concat_ws(',', CASE WHEN id % {NO_MACHINE_MOD} = 0 THEN 'missing_station_id' END,
                                CASE WHEN id % {BAD_TS_MOD} = 0 THEN 'invalid_timestamp' END) END AS reasons,
       CASE WHEN id % {TRUNCATED_MOD} = 0 OR id % {NO_MACHINE_MOD} = 0 OR id % {BAD_TS_MOD} = 0
            THEN NULL ELSE throughput_count END AS throughput_count,
       CASE WHEN id % {TRUNCATED_MOD} = 0 OR id % {NO_MACHINE_MOD} = 0 OR id % {BAD_TS_MOD} = 0
            THEN NULL ELSE "timestamp" END AS "timestamp"
FROM production_events
""")
def q_ingest_split_production(spark, sf):
    """SRC-4: production-event records -> typed rows or quarantine (line, station, timestamp required)."""
    c = ig.classify_records(damaged_production_lines(spark, sf), S.PRODUCTION_SCHEMA, ig.PRODUCTION_REQUIRED_FIELDS)
    ok = F.col("is_valid")
    return c.select(
        "line_source_id", F.when(ok, F.lit("valid")).otherwise(F.lit("rejected")).alias("status"),
        F.array_join("reject_reasons", ",").alias("reasons"),
        F.when(ok, F.col("throughput_count")).alias("throughput_count"), F.when(ok, F.col("timestamp")).alias("timestamp"))
