"""As-of join of two streams (ST-7): both sides arrive, state is bounded by their watermarks.

A reading can match an event only within the tolerance, so both sides are
gathered by key and time window, and Spark drops a window from state when the
watermark has passed it.  Each micro-batch matches the windows that have got rows
and keeps the latest reading for each event, and a reader takes the latest over
the micro-batches, as a better reading may arrive after a worse one.

Spark drops rows behind the watermark without a word.  ``late_gate`` stands
before the join and writes such rows to a table of their own instead.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timefn import seconds_between
from ..operators.asof import JOIN_KEYS
from .jobs import earlier_batches, write_batch


def late_gate(path: str, late_path: str, delay_seconds: float, time_col: str = "timestamp"):
    """foreachBatch: rows at most ``delay_seconds`` behind the newest row of earlier batches pass to ``path``.

    The others, and rows without a time, go to ``late_path`` with a ``late_reason``.
    What passes is never behind the watermark of a stream that reads ``path`` with
    the same delay.  The newest time of each batch is kept beside ``path``, so a replay decides alike.
    """
    seen = f"{path.rstrip('/')}_seen"

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = F.max(time_col).alias("newest")
        before = earlier_batches(batch.agg(newest), seen, batch_id).agg(F.max("newest")).first()[0]
        ts = F.col(time_col)
        limit = F.lit(before).cast("timestamp") - F.make_dt_interval(secs=F.lit(float(delay_seconds)))
        reason = F.when(ts.isNull(), "no_time").when(ts < limit, "late")
        b = batch.withColumn("late_reason", reason).persist()
        try:
            write_batch(b.where("late_reason is null").drop("late_reason"), path, batch_id)
            write_batch(b.where("late_reason is not null"), late_path, batch_id)
            write_batch(b.agg(newest), seen, batch_id)
        finally:
            b.unpersist()
    return write


def _tagged(df: DataFrame, side: int, keys: list[str], other: DataFrame) -> DataFrame:
    """One side's rows in the common layout: keys, time and a struct of the side, the row's other columns in it."""
    def rest(d: DataFrame) -> list[str]:
        return [c for c in d.columns if c not in (*keys, "timestamp")]

    def absent(d: DataFrame) -> Column:
        return F.lit(None).cast(d.select(F.struct(*rest(d)).alias("_r")).schema["_r"].dataType)
    s, p = (F.struct(*rest(df)), absent(other)) if side == 0 else (absent(other), F.struct(*rest(df)))
    return df.select(*keys, "timestamp", F.struct(F.col("timestamp").alias("at"), F.lit(side).alias("side"),
                                                  s.alias("_s"), p.alias("_e")).alias("_row"))


def asof_pairs(sensor: DataFrame, production: DataFrame, tolerance_seconds: float, delay: str,
               keys: list[str] | None = None) -> DataFrame:
    """(keys, window, rows): the rows of both sides, by key and time window, that can match one another.

    A window is twice the tolerance long and one begins with every tolerance, so
    all readings that an event can match are in the window that has the event in its
    second half.  Each row is held twice at most, however dense the readings are;
    no pairs are made.  In append mode a window comes once, when the watermark has
    passed it; in update mode whenever rows of it have arrived.

    ``delay`` is how far either stream may be out of order; state holds the
    rows of the delay and the windows.  Rows without a key or a time match nothing.
    """
    keys = keys or JOIN_KEYS
    s = sensor.dropna(subset=[*keys, "timestamp"]).withWatermark("timestamp", delay)
    p = production.dropna(subset=[*keys, "timestamp"]).withWatermark("timestamp", delay)
    both = _tagged(s, 0, keys, p).unionByName(_tagged(p, 1, keys, s))
    step = max(1, math.ceil(tolerance_seconds * 1_000_000))
    placed = both.withColumn("window", F.window("timestamp", f"{2 * step} microseconds", f"{step} microseconds"))
    half = F.unix_micros("window.start") + F.lit(step)
    needed = placed.where((F.col("_row.side") == 0) | (F.unix_micros("timestamp") >= half))
    return needed.groupBy(*keys, "window").agg(F.collect_list("_row").alias("rows"))


def matched(windows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, event_timestamp, _e, sensor_timestamp, _s): each event of ``asof_pairs`` with its latest reading.

    One window function over a window's rows in order of time, as in the batch
    operator; ties go to the highest reading id.
    """
    rows = windows.select(*keys, "window", F.explode("rows").alias("_r")).select(*keys, "window", "_r.*")
    order = [F.col("at"), F.col("side"), F.col("_s.id").asc_nulls_last()]
    upto = Window.partitionBy(*keys, "window").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = F.last(F.when(F.col("side") == 0, F.struct(F.col("at").alias("sensor_timestamp"), "_s")), ignorenulls=True).over(upto)
    found = rows.withColumn("_m", near).where((F.col("side") == 1) & F.col("_m").isNotNull())
    # the windows' step is the tolerance
    lag = F.unix_micros("at") - F.unix_micros("_m.sensor_timestamp")
    step = F.expr("(unix_micros(window.end) - unix_micros(window.start)) div 2")
    return found.where(lag <= step).select(*keys, F.col("at").alias("event_timestamp"), "_e", "_m.*")


def _latest(pairs: DataFrame, keys: list[str], event_key: Column) -> DataFrame:
    """The latest reading of each event; ties go to the highest reading id, as in the batch operator."""
    order = F.struct("sensor_timestamp", F.col("_s.id").isNull(), "_s.id")
    found = F.struct(*keys, "event_timestamp", "_e", "sensor_timestamp", "_s")
    return pairs.groupBy(event_key.alias("_event")).agg(F.max_by(found, order).alias("_r")).select("_r.*")


def asof_upsert_writer(path: str, keys: list[str] | None = None, event_key: str = "_e.id"):
    """foreachBatch for ``asof_pairs``: each micro-batch's latest reading of each event."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(_latest(matched(batch, keys or JOIN_KEYS), keys or JOIN_KEYS, F.col(event_key)), path, batch_id)
    return write


def read_asof(spark: SparkSession, path: str, keys: list[str] | None = None, event_key: str = "_e.id") -> DataFrame:
    """The joined rows as ``asof.asof_join`` gives them: the latest reading over all micro-batches."""
    keys = keys or JOIN_KEYS
    best = _latest(spark.read.parquet(path), keys, F.col(event_key))
    s_cols, p_cols = (best.schema[c].dataType.fieldNames() for c in ("_s", "_e"))
    clash = set(s_cols) & set(p_cols)
    return best.select(
        *keys, F.col("event_timestamp").alias("timestamp"),
        *[F.col(f"_e.{c}").alias(f"{c}_prod" if c in clash else c) for c in p_cols],
        *[F.col(f"_s.{c}").alias(c) for c in s_cols], "event_timestamp", "sensor_timestamp",
        seconds_between(F.col("event_timestamp"), F.col("sensor_timestamp")).alias("join_lag_seconds"))
