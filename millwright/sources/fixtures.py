"""Adapters that turn the driver's ``events`` table into factory tables.

The driver data has no factory tables, so three deterministic views map each
event onto a sensor reading, a production event or a prediction row (see
FIXTURES.md section 3).  They are plain projections: one scan of ``events``,
filter pushed to Parquet, no shuffle.  The modulus constants below are the
documented fixture definition (fixed values), not sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import shift_of

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
SENSOR_TYPES = ["view", "click", "error"]
PRODUCTION_TYPES = ["purchase", "signup"]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*EVENT_COLUMNS)


def _base(ev: DataFrame) -> DataFrame:
    """Common derived columns: k, dimensions, UTC timestamp, arrival time."""
    eid = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        "*",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("machine_id"),
        F.concat(F.lit("L"), (F.col("user_id") % 5).cast("string")).alias("line_id"),
        F.concat(F.lit("ST"), (F.col("user_id") % 25).cast("string")).alias("station_id"),
        ts.alias("timestamp"),
        F.timestamp_micros(F.unix_micros(ts) + (eid % 120) * 1_000_000).alias("created_at"),
    )


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir).where(F.col("event_type").isin(SENSOR_TYPES))
    b = _base(ev)
    eid, v, k, uid = F.col("event_id"), F.col("value"), F.col("k"), F.col("user_id")
    dropout = (eid % 71) == 0
    null_d = F.lit(None).cast("double")

    def gappy(expr):
        return F.when(dropout, null_d).otherwise(expr)

    rms = (F.when((eid % 97) == 0, null_d)
            .when((eid % 89) == 0, F.lit(-1.0))
            .when(((uid % 10) == 3) & ((eid % 5) != 0), F.lit(2.5))
            .otherwise(v / 25.0))
    base = b.select(
        eid.alias("src_id"),
        "machine_id", "line_id", "station_id", "timestamp",
        gappy(22.0 + k / 10.0).alias("air_temperature"),
        gappy(40.0 + v * 0.3).alias("process_temperature"),
        gappy(rms).alias("vibration_rms"),
        gappy(v * 0.12).alias("vibration_peak"),
        gappy(F.when((eid % 83) == 0, F.lit(-5.0)).otherwise(100.0 + k / 10.0)).alias("pressure"),
        (10.0 + k * 0.3).alias("torque"),
        (1800.0 - k * 2.0).alias("rotational_speed"),
        (3.0 + v / 20.0).alias("motor_current"),
        (1.0 + v / 50.0).alias("power_consumption"),
        (k * 1.1).alias("tool_wear"),
        (eid / 10.0).alias("operating_hours"),
        (0.5 + k / 200.0).alias("production_load"),
        (30.0 + k * 0.5).alias("ambient_humidity"),
        "created_at",
    )
    originals = base.select(F.col("src_id").alias("id"),
                            F.concat(F.lit("SEN_"), F.col("src_id").cast("string")).alias("event_id"),
                            *[c for c in base.columns if c != "src_id"])
    # Re-sent copies of every 101st reading (same payload, new id) -> duplicates.
    # Event ids are not negative, so -(id + 1) is the id of no other row at any size.
    copies = (base.where((F.col("src_id") % 101) == 0)
              .select((-F.col("src_id") - 1).alias("id"),
                      F.concat(F.lit("SEN_"), F.col("src_id").cast("string"), F.lit("_DUP")).alias("event_id"),
                      *[c for c in base.columns if c != "src_id"]))
    return originals.unionByName(copies)


def production_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir).where(F.col("event_type").isin(PRODUCTION_TYPES))
    b = _base(ev)
    eid, v, k = F.col("event_id"), F.col("value"), F.col("k")
    return b.select(
        eid.alias("id"),
        F.concat(F.lit("PROD_"), eid.cast("string")).alias("event_id"),
        "line_id", "station_id",
        F.concat(F.lit("B"), (eid % 50).cast("string")).alias("batch_id"),
        shift_of(F.col("timestamp")).alias("shift"),
        "timestamp",
        F.when((eid % 73) == 0, F.lit(-1.0)).otherwise(4.0 + v / 20.0).alias("cycle_time_sec"),
        F.when((eid % 67) == 0, F.lit(None).cast("int")).otherwise(k % 20).alias("throughput_count"),
        F.lit(12).alias("target_throughput"),
        F.when((eid % 61) == 0, F.lit(1.2)).otherwise(0.99 - k / 1000.0).alias("station_yield"),
        (k % 5).alias("reject_count"),
        (k % 3).alias("rework_count"),
        (k / 500.0).alias("defect_rate"),
        (k % 7).alias("micro_stop_count"),
        (v / 10.0).alias("downtime_minutes"),
        (k % 60).alias("wip_count"),
        (k % 25).alias("queue_length"),
        (0.95 - k / 1000.0).alias("inspection_score_proxy"),
        (1.0 - k / 200.0).alias("process_stability_index"),
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (eid % 3 + 1).cast("int")).alias("operator_group"),
        "created_at",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-output stand-in: deterministic scores per event."""
    b = _base(read_events(spark, sf_dir))
    eid, v, k = F.col("event_id"), F.col("value"), F.col("k")
    return b.select(
        eid.alias("id"), "machine_id", "line_id", "station_id", "timestamp",
        (k / 100.0).alias("failure_probability"),
        (v * 4.0).alias("rul_estimate_hours"),
        F.when((eid % 97) == 0, F.lit(None).cast("double")).otherwise(-v / 1000.0).alias("anomaly_score"),
        F.when(v > 150.0, F.lit(1)).otherwise(F.lit(0)).alias("anomaly_flag"),
        (k * 1.0).alias("tool_wear"),
        (1.0 - k / 200.0).alias("process_stability_index"),
        (v * 0.2).alias("temperature_delta"),
    )
