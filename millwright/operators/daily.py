"""Daily partial results behind the KPI read models (AG-1, AG-4, SC-10).

Each day's rows are reduced once to three small tables, partitioned by day:

* ``counts``: for each input table its rows, flagged rows and latest time;
* ``keys``: the distinct machines and lines that were seen, as exact key sets;
* ``latest``: the latest prediction of each machine.

All of them merge: counts add up, key sets unite, the later prediction wins.  A
read model merges the days and never scans history; a day that is computed again
(late rows) replaces itself.  Rows without a time belong to a day of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("counts", "keys", "latest")


def _day() -> Column:
    return F.coalesce(F.to_date("timestamp").cast("string"), F.lit("none")).alias("day")


def partials(sensor: DataFrame, production: DataFrame, issues: DataFrame, scored: DataFrame, alerts: DataFrame) -> dict[str, DataFrame]:
    """The three tables of the days in the inputs; each input is scanned once, with map-side combine."""
    def rows(kind: str, df: DataFrame, flag: Column | None = None) -> DataFrame:
        return df.select(_day(), F.lit(kind).alias("kind"), F.col("timestamp").cast("timestamp").alias("timestamp"),
                         (flag if flag is not None else F.lit(0)).cast("long").alias("flag"))

    flags = F.coalesce(F.col("anomaly_flag").cast("long"), F.lit(0))
    tagged = rows("sensor", sensor).unionByName(rows("production", production)).unionByName(rows("issue", issues)).unionByName(
        rows("prediction", scored, flags)).unionByName(rows("alert", alerts))
    counts = tagged.groupBy("day", "kind").agg(F.count("*").alias("n"), F.sum("flag").alias("flags"), F.max("timestamp").alias("latest"))

    def seen(kind: str, df: DataFrame, column: str) -> DataFrame:
        return df.where(F.col(column).isNotNull()).select(_day(), F.lit(kind).alias("kind"), F.col(column).cast("string").alias("key"))

    keys = seen("machine", sensor, "machine_id").unionByName(seen("line", sensor, "line_id")).unionByName(
        seen("line", production, "line_id")).distinct()
    held = scored.where("machine_id is not null and timestamp is not null").withColumn("_day", _day())
    latest = held.groupBy(F.col("_day").alias("day"), "machine_id").agg(
        F.max_by(F.struct("timestamp", "id", "risk_level", "health_score", "rul_estimate_hours"), F.struct("timestamp", "id")).alias("r"))
    return {"counts": counts, "keys": keys, "latest": latest.select("day", "machine_id", "r.*")}


def write_days(root: str, parts: dict[str, DataFrame]) -> None:
    """Writes the days of ``parts``; other days stay as they are."""
    for name in TABLES:
        parts[name].repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{root}/{name}")


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def _of(kind: str, value: Column) -> Column:
    return F.when(F.col("kind") == kind, value)


def _total(kind: str) -> Column:
    return F.coalesce(F.sum(_of(kind, F.col("n"))), F.lit(0).cast("long"))


def acquisition_status(spark: SparkSession, root: str) -> DataFrame:
    """AG-1 from the daily counts."""
    return _read(spark, root, "counts").agg(
        _total("sensor").alias("sensor_readings"), _total("production").alias("production_events"), _total("issue").alias("data_quality_issues"),
        F.max(_of("sensor", F.col("latest"))).alias("latest_sensor_timestamp"),
        F.max(_of("production", F.col("latest"))).alias("latest_production_timestamp"))


def latest_predictions(spark: SparkSession, root: str) -> DataFrame:
    """The latest prediction of each machine over all days."""
    rows = _read(spark, root, "latest")
    return rows.groupBy("machine_id").agg(F.max_by(
        F.struct("timestamp", "id", "risk_level", "health_score", "rul_estimate_hours"), F.struct("timestamp", "id")).alias("r")).select("machine_id", "r.*")


def executive_kpis(spark: SparkSession, root: str) -> DataFrame:
    """AG-4 from the daily tables: one aggregate of a row for each day, key and machine."""
    null = F.lit(None)
    keys = _read(spark, root, "keys").select("kind", "key", null.cast("long").alias("n"), null.cast("string").alias("risk"),
                                             null.cast("double").alias("health"), null.cast("double").alias("rul"))
    counts = _read(spark, root, "counts").select(
        "kind", null.cast("string").alias("key"), F.when(F.col("kind") == "prediction", F.col("flags")).otherwise(F.col("n")).alias("n"),
        null.cast("string").alias("risk"), null.cast("double").alias("health"), null.cast("double").alias("rul"))
    last = latest_predictions(spark, root).select(
        F.lit("last").alias("kind"), null.cast("string").alias("key"), null.cast("long").alias("n"), F.col("risk_level").alias("risk"),
        F.col("health_score").alias("health"), F.col("rul_estimate_hours").alias("rul"))
    k = keys.unionByName(counts).unionByName(last).agg(
        F.count_distinct(_of("machine", F.col("key"))).alias("total_machines"), F.count_distinct(_of("line", F.col("key"))).alias("total_lines"),
        F.count_if((F.col("kind") == "last") & F.col("risk").isin("high", "critical")).alias("critical_machines"),
        F.avg("health").alias("avg_health_score"), F.avg("rul").alias("avg_rul_hours"), _total("alert").alias("_alerts"), _total("prediction").alias("_flags"))
    return k.withColumn("anomaly_count", F.when(F.col("_alerts") > 0, F.col("_alerts")).otherwise(F.col("_flags"))).drop("_alerts", "_flags")


def shift_counts(spark: SparkSession, root: str) -> DataFrame:
    """SC-10's counts, means and latest prediction time from the daily tables."""
    counts = _read(spark, root, "counts").agg(
        _total("sensor").alias("sensor_readings"), _total("production").alias("production_events"), _total("prediction").alias("predictions"),
        _total("alert").alias("anomaly_alerts"), _total("issue").alias("data_quality_issues"),
        F.coalesce(F.sum(_of("prediction", F.col("flags"))), F.lit(0).cast("long")).alias("_flags"),
        F.max(_of("prediction", F.col("latest"))).alias("latest_prediction_timestamp"))
    means = latest_predictions(spark, root).agg(F.avg("health_score").alias("avg_health_score"), F.avg("rul_estimate_hours").alias("avg_rul_hours"))
    one = F.lit(1).alias("_k")  # two one-row tables
    both = counts.select("*", one).join(means.select("*", one), "_k").drop("_k")
    return both.withColumn("anomaly_count", F.when(F.col("anomaly_alerts") > 0, F.col("anomaly_alerts")).otherwise(F.col("_flags"))).drop("_flags")
