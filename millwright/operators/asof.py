"""Backward as-of join with tolerance (JN-1) and latest-pair join (JN-2).

Semantics: every production event takes the latest sensor reading of the same
(line, station) at or before its timestamp; readings of all machines of the
station compete; ties on the sensor timestamp go to the highest sensor id; a
match older than ``tolerance_seconds`` is dropped, as are events without one.

Plan: the tolerance bounds how far back a match can lie, so time is cut into
buckets of its length and (keys, bucket) is the unit of work.  Both sides are
united and shuffled once; within a bucket a window carries the last reading to
each event.  An event without one in its own bucket can only match the last
reading of the bucket before, from a table with one row for each bucket (an
aggregate with map-side combine).  So a reading is copied once at most, however
far readings lie apart.  No range join, no pairs, no checkpoint, and a hot
station is as many tasks as it has buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import seconds_between

JOIN_KEYS = ["line_id", "station_id"]


def asof_join(sensor: DataFrame, production: DataFrame, tolerance_seconds: float = 300.0,
              keys: list[str] | None = None) -> DataFrame:
    keys = keys or JOIN_KEYS
    s = sensor.dropna(subset=[*keys, "timestamp"])
    p = production.dropna(subset=[*keys, "timestamp"])
    shared = set(keys) | {"timestamp"}
    clash = (set(s.columns) & set(p.columns)) - shared
    s_cols = [c for c in s.columns if c not in shared]
    p_cols = [c for c in p.columns if c not in shared]
    s_id = F.col("id") if "id" in s.columns else F.lit(None).cast("long")
    p_id = F.col("id") if "id" in p.columns else F.lit(None).cast("long")

    s_tag = s.select(*keys, "timestamp", F.lit(0).alias("_side"), s_id.alias("_id"),
                     F.struct(F.col("timestamp").alias("sensor_timestamp"), *s_cols).alias("_s"),
                     F.lit(None).cast(p.select(F.struct(*p_cols)).schema[0].dataType).alias("_e"))
    p_tag = p.select(*keys, "timestamp", F.lit(1).alias("_side"), p_id.alias("_id"),
                     F.lit(None).cast(s_tag.schema["_s"].dataType).alias("_s"),
                     F.struct(*p_cols).alias("_e"))
    u = s_tag.unionByName(p_tag)
    width = max(1, math.ceil(tolerance_seconds * 1_000_000))  # microseconds
    bucket = F.floor(F.unix_micros("timestamp") / F.lit(width)).cast("long")
    u = u.withColumn("_b", bucket)
    order = [F.col("timestamp"), F.col("_side"), F.col("_id").asc_nulls_last()]
    upto = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = u.withColumn("_in", F.last("_s", ignorenulls=True).over(upto)).where(F.col("_side") == 1)
    # the last reading of each bucket, put before the next bucket
    newest = F.struct("timestamp", F.col("_id").isNull(), "_id")
    last = s_tag.withColumn("_b", bucket).groupBy(*keys, "_b").agg(F.max_by("_s", newest).alias("_before"))
    before = last.withColumn("_b", F.col("_b") + 1)
    ev = inside.join(before, [*keys, "_b"], "left").withColumn("_m", F.coalesce("_in", "_before"))
    lag = seconds_between(F.col("timestamp"), F.col("_m.sensor_timestamp"))
    ev = ev.where(F.col("_m").isNotNull() & (lag <= F.lit(float(tolerance_seconds))))
    prod_out = [F.col(f"_e.{c}").alias(f"{c}_prod" if c in clash else c) for c in p_cols]
    sens_out = [F.col(f"_m.{c}").alias(c) for c in s_cols]
    return ev.select(
        *keys, "timestamp", *prod_out, *sens_out,
        F.col("timestamp").alias("event_timestamp"),
        F.col("_m.sensor_timestamp").alias("sensor_timestamp"),
        lag.alias("join_lag_seconds"),
    )


def latest_pair(sensor: DataFrame, production: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """JN-2: each (line, station)'s latest sensor row paired with its latest
    production row.  Both sides are reduced to one row per key first (partial
    aggregates), so the join never multiplies rows."""
    from .readmodels import latest_per_group

    keys = keys or JOIN_KEYS
    ls = latest_per_group(sensor, keys)
    lp = latest_per_group(production, keys)
    ls = ls.select(*keys, *[F.col(c).alias(f"sensor_{c}") for c in ls.columns if c not in keys])
    lp = lp.select(*keys, *[F.col(c).alias(f"production_{c}") for c in lp.columns if c not in keys])
    return ls.join(lp, keys, "inner")
