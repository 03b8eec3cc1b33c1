"""Operator read models: KPIs, line summaries, queues, reports, trend series.

Each function is DataFrame -> DataFrame.  Aggregations are expressed with
``groupBy().agg`` so Spark does a map-side partial aggregate before the
shuffle (hot lines or machines only ever ship one partial row per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import to_double
from ..functions.timefn import age_text, seconds_between


# --------------------------------------------------------------------- AG-2
def line_operational_summary(production: DataFrame) -> DataFrame:
    """Per line: events, mean cycle, mean yield, downtime and reject totals, last ts."""
    return production.groupBy("line_id").agg(
        F.count(F.lit(1)).alias("production_event_count"),
        F.avg("cycle_time_sec").alias("avg_cycle_time_sec"),
        F.avg("station_yield").alias("avg_station_yield"),
        F.sum(F.coalesce(F.col("downtime_minutes"), F.lit(0.0))).alias("total_downtime_minutes"),
        F.sum(F.coalesce(F.col("reject_count"), F.lit(0)).cast("long")).alias("total_reject_count"),
        F.max("timestamp").alias("latest_production_timestamp"),
    )


# --------------------------------------------------------------------- AG-1
def _tagged(**frames: DataFrame) -> DataFrame:
    """Union of (tag, timestamp) rows: several tables summarised by ONE aggregate."""
    out = None
    for tag, f in frames.items():
        ts = F.col("timestamp") if "timestamp" in f.columns else F.lit(None).cast("timestamp")
        part = f.select(F.lit(tag).alias("_tag"), ts.cast("timestamp").alias("_ts"))
        out = part if out is None else out.unionByName(part)
    return out


def acquisition_status(sensor: DataFrame, production: DataFrame, issues: DataFrame) -> DataFrame:
    """Row counts of three tables and the latest timestamps, as one row."""
    u = _tagged(s=sensor, p=production, q=issues)
    t = F.col("_tag")
    return u.agg(
        F.count_if(t == "s").alias("sensor_readings"),
        F.count_if(t == "p").alias("production_events"),
        F.count_if(t == "q").alias("data_quality_issues"),
        F.max(F.when(t == "s", F.col("_ts"))).alias("latest_sensor_timestamp"),
        F.max(F.when(t == "p", F.col("_ts"))).alias("latest_production_timestamp"),
    )


# --------------------------------------------------------------------- AG-3
def risk_band_line(avg_health) -> F.Column:
    """Line risk scale (fixed values 80 / 60 / 40); null -> unknown."""
    return (F.when(avg_health.isNull(), F.lit("unknown"))
             .when(avg_health >= 80, F.lit("low"))
             .when(avg_health >= 60, F.lit("medium"))
             .when(avg_health >= 40, F.lit("high"))
             .otherwise(F.lit("critical")))


def line_health(scored: DataFrame, alerts: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Health of every line at once: prediction aggregates + alert count.

    ``lines`` (one column ``line_id``) lists the lines to report; a line with
    no predictions still yields a row with risk ``unknown``.  Default: lines
    seen in predictions or alerts.
    """
    agg = scored.where(F.col("line_id").isNotNull()).groupBy("line_id").agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.avg("health_score").alias("avg_health_score"),
        F.max("failure_probability").alias("max_failure_probability"),
        F.min("rul_estimate_hours").alias("min_rul_estimate_hours"),
        F.min("anomaly_score").alias("min_anomaly_score"),
    )
    ac = alerts.where(F.col("line_id").isNotNull()).groupBy("line_id").agg(
        F.count(F.lit(1)).alias("alert_count"))
    if lines is None:
        lines = agg.select("line_id").unionByName(ac.select("line_id")).distinct()
    out = (lines.join(agg, "line_id", "left").join(ac, "line_id", "left")
           .withColumn("prediction_count", F.coalesce("prediction_count", F.lit(0).cast("long")))
           .withColumn("alert_count", F.coalesce("alert_count", F.lit(0).cast("long"))))
    return out.withColumn("risk_level", risk_band_line(F.col("avg_health_score")))


# --------------------------------------------------------------------- WN-7
def latest_per_group(df: DataFrame, keys: list[str], ts: str = "timestamp", tie: str = "id") -> DataFrame:
    """One latest row per group without sorting the group.

    ``max_by(struct, (ts, tie))`` is an aggregate: partial per task, so a hot
    machine never lands whole in one task.  Null timestamps never win; null
    keys are dropped.
    """
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    base = df.where(cond & F.col(ts).isNotNull())
    others = [c for c in df.columns if c not in keys]
    picked = base.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(F.col(ts), F.col(tie))).alias("_r"))
    return picked.select(*keys, "_r.*")


# --------------------------------------------------------------------- JN-3 / WN-8
def latest_with_ties(df: DataFrame, key: str = "machine_id", ts: str = "timestamp") -> DataFrame:
    """All rows at each key's maximum timestamp (ties kept).

    Group-max then equi-join on (key, ts): the join is hashed on both columns,
    so a machine with many rows is spread over many partitions.
    """
    base = df.where(F.col(key).isNotNull())
    mx = base.groupBy(key).agg(F.max(ts).alias("_max_ts"))
    return (base.join(mx, (base[key] == mx[key]) & (base[ts] == mx["_max_ts"]), "inner")
            .drop(mx[key]).drop("_max_ts"))


# --------------------------------------------------------------------- AG-4
def executive_kpis(sensor: DataFrame, production: DataFrame, latest_scored: DataFrame,
                   alerts: DataFrame, scored: DataFrame) -> DataFrame:
    """One-row KPI table from a tagged union of the five inputs (one aggregate)."""
    none_s, none_d = F.lit(None).cast("string"), F.lit(None).cast("double")

    def part(tag, df, machine=None, line=None, risk=None, health=None, rul=None, flag=None):
        def g(name, default, cast):
            return F.col(name).cast(cast) if name and name in df.columns else default
        return df.select(F.lit(tag).alias("_tag"), g(machine, none_s, "string").alias("_m"),
                         g(line, none_s, "string").alias("_l"), g(risk, none_s, "string").alias("_r"),
                         (to_double(health) if health else none_d).alias("_h"),
                         (to_double(rul) if rul else none_d).alias("_u"),
                         g(flag, F.lit(None).cast("long"), "long").alias("_f"))

    u = (part("s", sensor, machine="machine_id", line="line_id")
         .unionByName(part("p", production, line="line_id"))
         .unionByName(part("l", latest_scored, risk="risk_level", health="health_score",
                           rul="rul_estimate_hours"))
         .unionByName(part("a", alerts))
         .unionByName(part("x", scored, flag="anomaly_flag")))
    t = F.col("_tag")
    k = u.agg(
        F.count_distinct(F.when(t == "s", F.col("_m"))).alias("total_machines"),
        F.count_distinct(F.when(t.isin("s", "p"), F.col("_l"))).alias("total_lines"),
        F.count_if((t == "l") & F.col("_r").isin("high", "critical")).alias("critical_machines"),
        F.avg(F.when(t == "l", F.col("_h"))).alias("avg_health_score"),
        F.avg(F.when(t == "l", F.col("_u"))).alias("avg_rul_hours"),
        F.count_if(t == "a").alias("_n_alerts"),
        F.coalesce(F.sum(F.when(t == "x", F.coalesce(F.col("_f"), F.lit(0)))), F.lit(0).cast("long"))
        .alias("_flags"),
    )
    return (k.withColumn("anomaly_count",
                         F.when(F.col("_n_alerts") > 0, F.col("_n_alerts")).otherwise(F.col("_flags")))
            .drop("_n_alerts", "_flags"))


# --------------------------------------------------------------------- AG-5
def line_health_summary(latest_scored: DataFrame) -> DataFrame:
    return latest_scored.groupBy("line_id").agg(
        F.countDistinct("machine_id").alias("machines"),
        F.avg("health_score").alias("avg_health_score"),
        F.max("failure_probability").alias("max_failure_probability"),
        F.min("rul_estimate_hours").alias("min_rul_hours"),
    )


# --------------------------------------------------------------------- AG-6
def issue_counts(issues: DataFrame) -> DataFrame:
    """Counts by (issue_type, severity); marginals are a rollup of it."""
    return issues.groupBy("issue_type", "severity").agg(F.count(F.lit(1)).alias("issue_count"))


def issue_marginals(issues: DataFrame) -> DataFrame:
    """Counts by type and severity, by type, by severity and in total, in one pass (grouping sets).

    ``level`` says which: ``type_severity``, ``type``, ``severity`` or ``total``; columns that a level
    sums over are null.  ``type_rank`` orders the types by falling count, then name.
    """
    kind = F.coalesce("issue_type", F.lit("unknown")), F.coalesce("severity", F.lit("unknown"))
    cells = issues.select(kind[0].alias("issue_type"), kind[1].alias("severity"))
    sums = cells.groupingSets([["issue_type", "severity"], ["issue_type"], ["severity"], []], "issue_type", "severity").agg(
        F.count(F.lit(1)).alias("issue_count"), F.grouping_id().alias("_g"))
    level = F.when(F.col("_g") == 0, "type_severity").when(F.col("_g") == 1, "type").when(F.col("_g") == 2, "severity").otherwise("total")
    sums = sums.select("issue_type", "severity", "issue_count", level.alias("level"))
    # a row for each type and severity at most
    by_count = Window.partitionBy("level").orderBy(F.col("issue_count").desc(), "issue_type")
    return sums.withColumn("type_rank", F.when(F.col("level") == "type", F.row_number().over(by_count)))


# --------------------------------------------------------------------- AG-7
def ingest_per_minute(sensor: DataFrame, production: DataFrame) -> DataFrame:
    s = sensor.select(F.col("timestamp"), F.lit("sensor").alias("stream_type"))
    p = production.select(F.col("timestamp"), F.lit("production").alias("stream_type"))
    return (s.unionByName(p).where(F.col("timestamp").isNotNull())
            .groupBy(F.date_trunc("minute", "timestamp").alias("minute"), "stream_type")
            .agg(F.count(F.lit(1)).alias("records")))


# --------------------------------------------------------------------- AG-8
def ingestion_kpis(sensor: DataFrame, production: DataFrame, issues: DataFrame,
                   logs: DataFrame | None = None) -> DataFrame:
    frames = {"s": sensor.select("timestamp"), "p": production.select("timestamp")}
    u = _tagged(**frames).withColumn("_it", F.lit(None).cast("string")).withColumn(
        "_st", F.lit(None).cast("string"))
    u = u.unionByName(issues.select(F.lit("q").alias("_tag"), F.lit(None).cast("timestamp").alias("_ts"),
                                    F.col("issue_type").alias("_it"), F.lit(None).cast("string").alias("_st")))
    if logs is not None:
        u = u.unionByName(logs.select(F.lit("g").alias("_tag"), F.lit(None).cast("timestamp").alias("_ts"),
                                      F.lit(None).cast("string").alias("_it"),
                                      F.lower(F.col("status").cast("string")).alias("_st")))
    t, it = F.col("_tag"), F.col("_it")
    k = u.agg(
        F.max(F.when(t.isin("s", "p"), F.col("_ts"))).alias("last_received_timestamp"),
        F.count_if(t.isin("s", "p")).alias("successful_ingestion_count"),
        F.count_if((t == "g") & F.col("_st").isin("failed", "error")).alias("failed_ingestion_count"),
        F.count_if((t == "q") & (it == "delayed_reading")).alias("delayed_readings"),
        F.count_if((t == "q") & (it == "timestamp_gap")).alias("_gaps"),
        F.count_if((t == "q") & (it == "sensor_dropout")).alias("_dropouts"),
    )
    return (k.withColumn("buffered_records_proxy",
                         F.col("_gaps") + F.col("_dropouts") + F.col("failed_ingestion_count"))
            .drop("_gaps", "_dropouts"))


# --------------------------------------------------------------------- SC-9
def freshness_state(last_ts, as_of) -> list:
    age = seconds_between(as_of, last_ts)
    state = (F.when(last_ts.isNull(), F.lit("Waiting for data"))
              .when(age < 120, F.lit("Live stream active"))
              .when(age < 3600, F.lit("Stream delayed"))
              .otherwise(F.lit("Replay / offline dataset")))
    collector = F.when(last_ts.isNull() | (age < 120), F.lit("active")).otherwise(F.lit("stale"))
    return [age.alias("age_seconds"), state.alias("ingestion_state"), collector.alias("collector_status")]


def freshness(sensor: DataFrame, production: DataFrame, as_of: str) -> DataFrame:
    last = (sensor.select("timestamp").unionByName(production.select("timestamp"))
            .agg(F.max("timestamp").alias("last_received_timestamp")))
    at = F.lit(as_of).cast("timestamp")
    return last.select("last_received_timestamp", *freshness_state(F.col("last_received_timestamp"), at),
                       age_text(F.col("last_received_timestamp"), at).alias("age_text"))


# --------------------------------------------------------------------- AG-9
def line_monitor_kpis(production: DataFrame, line_id: str | None = None) -> DataFrame:
    df = production if line_id is None else production.where(F.col("line_id") == line_id)
    return df.groupBy("line_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.avg(to_double("cycle_time_sec")).alias("avg_cycle_time_sec"),
        F.avg(to_double("station_yield")).alias("avg_station_yield"),
        F.sum(to_double("downtime_minutes")).alias("total_downtime_minutes"),
    )


# --------------------------------------------------------------------- SC-11
def risk_posture(alerts: DataFrame, scored: DataFrame) -> DataFrame:
    u = (alerts.select(F.lit("a").alias("_tag"), F.lower(F.col("severity")).alias("_lvl"))
         .unionByName(scored.select(F.lit("p").alias("_tag"), F.lower(F.col("risk_level")).alias("_lvl"))))
    hi = F.col("_lvl").isin("high", "critical")
    k = u.agg(F.count_if((F.col("_tag") == "a") & hi).alias("_a"),
              F.count_if((F.col("_tag") == "p") & hi).alias("_p"))
    return k.select(
        F.when(F.col("_a") > 0, F.col("_a")).otherwise(F.col("_p")).alias("high_risk_count"),
        F.when(F.col("_a") > 0, F.lit("alerts")).otherwise(F.lit("predictions")).alias("basis"))


# --------------------------------------------------------------------- SC-12
PRODUCTION_TREND_METRICS = ["throughput_count", "target_throughput", "cycle_time_sec", "station_yield",
                            "defect_rate", "micro_stop_count", "downtime_minutes"]


SENSOR_TREND_METRICS = ["vibration_rms", "process_temperature", "motor_current", "torque", "tool_wear"]


def trend_series(df: DataFrame, metrics: list[str] | None = None,
                 keys: tuple = ("id", "line_id", "station_id", "timestamp")) -> DataFrame:
    """Tidy (keys..., metric, value) series via one unpivot (production or sensor trends)."""
    metrics = metrics or PRODUCTION_TREND_METRICS
    wide = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(keys), metrics, "metric", "value")


def anomaly_timeline(scored: DataFrame) -> DataFrame:
    """Per machine: time, anomaly score and flag (for the anomaly timeline view)."""
    return scored.select("id", "machine_id", "line_id", "timestamp", "anomaly_score",
                         F.coalesce(F.col("anomaly_flag").cast("int"), F.lit(0)).alias("anomaly_flag"))


# --------------------------------------------------------------------- AG-15
def time_span(*frames: DataFrame) -> DataFrame:
    u = None
    for f in frames:
        part = f.select(F.col("timestamp"))
        u = part if u is None else u.unionByName(part)
    return u.agg(F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"))


# --------------------------------------------------------------------- SC-5
PRIORITY_RANK = {"P1": 0, "P2": 1, "P3": 2, "Monitor": 3}
# Queue texts.
DEFAULT_PREDICTION_ACTION = "Inspect asset and validate current process condition."
DEFAULT_ALERT_ACTION = "Review recent sensor and production trend before shift handover."
ISSUE_ACTION = "Verify data acquisition channel before using model output for decisions."
MONITOR_ROW = ("Monitor", "All lines", "System", "No high-priority action generated",
               "Continue collecting data, refresh model outputs, and review dashboard at shift handover.")
QUEUE_COLUMNS = ["priority", "area", "asset", "signal", "suggested_action"]


def _area() -> F.Column:
    return F.concat(F.coalesce(F.col("line_id"), F.lit("N/A")), F.lit(" / "),
                    F.coalesce(F.col("station_id"), F.lit("N/A")))


def action_queue(latest_scored: DataFrame, alerts: DataFrame, issues: DataFrame, max_items: int = 8) -> DataFrame:
    """Operator action queue: risky machines (P1/P2), newest alerts, data-quality items (P3).

    Each feed keeps a (feed, seq) pair so ties sort as the feeds were listed;
    ``distinct`` is on the visible columns.  Top-``max_items`` is the feature
    (planned as a distributed top-k).  An empty queue yields one Monitor row.
    """
    risk = F.lower(F.col("risk_level"))
    health_txt = F.when(F.col("health_score").isNull(), F.lit("N/A")).otherwise(
        F.format_string("%.2f", F.col("health_score").cast("double")))
    preds = latest_scored.where(risk.isin("high", "critical")).select(
        F.when(risk == "critical", F.lit("P1")).otherwise(F.lit("P2")).alias("priority"),
        _area().alias("area"), F.coalesce(F.col("machine_id"), F.lit("N/A")).alias("asset"),
        F.concat(F.upper(F.col("risk_level")), F.lit(" risk, health "), health_txt).alias("signal"),
        F.coalesce(F.col("recommended_action"), F.lit(DEFAULT_PREDICTION_ACTION)).alias("suggested_action"),
        F.lit(1).alias("_feed"),
        F.struct(F.unix_micros(F.col("timestamp").cast("timestamp")).alias("a"),
                 F.col("machine_id").cast("string").alias("b")).alias("_seq"))
    newest_alerts = alerts.orderBy(F.col("id").desc()).limit(max_items)
    sev = F.lower(F.col("severity"))
    al = newest_alerts.select(
        F.when(sev == "critical", F.lit("P1")).otherwise(F.lit("P2")).alias("priority"),
        _area().alias("area"), F.coalesce(F.col("machine_id"), F.lit("N/A")).alias("asset"),
        F.concat(F.lit("Anomaly alert: "), F.coalesce(F.col("anomaly_score").cast("string"), F.lit("N/A")))
        .alias("signal"),
        F.coalesce(F.col("message"), F.lit(DEFAULT_ALERT_ACTION)).alias("suggested_action"),
        F.lit(2).alias("_feed"),
        F.struct((-F.col("id")).cast("long").alias("a"), F.lit("").alias("b")).alias("_seq"))
    severe = F.lower(F.col("severity")).isin("high", "critical")
    # Severe issues if any exist, else any issues; newest three.  The probe
    # reads at most one row.
    pool = issues.where(severe) if not issues.where(severe).isEmpty() else issues
    top_issues = pool.orderBy(F.col("timestamp").desc_nulls_last(), F.col("entity_id").desc_nulls_last(),
                              F.col("issue_type")).limit(3)
    dq = top_issues.select(
        F.lit("P3").alias("priority"), _area().alias("area"),
        F.coalesce(F.col("machine_id"), F.col("entity_id"), F.lit("N/A")).alias("asset"),
        F.concat(F.lit("Data quality: "), F.coalesce(F.col("issue_type"), F.lit("N/A"))).alias("signal"),
        F.lit(ISSUE_ACTION).alias("suggested_action"), F.lit(3).alias("_feed"),
        F.struct((-F.unix_micros(F.col("timestamp").cast("timestamp"))).alias("a"),
                 F.col("entity_id").cast("string").alias("b")).alias("_seq"))
    rows = preds.unionByName(al).unionByName(dq)
    first = rows.groupBy(*QUEUE_COLUMNS).agg(F.min(F.struct("_feed", "_seq")).alias("_o"))
    rank = F.element_at(F.create_map(*[x for kv in PRIORITY_RANK.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]),
                        F.col("priority"))
    top = first.orderBy(F.coalesce(rank, F.lit(9)), F.col("area"), F.col("_o"), F.col("signal"),
                        F.col("asset"), F.col("suggested_action")).limit(max_items)
    monitor = latest_scored.sparkSession.createDataFrame([MONITOR_ROW], ", ".join(f"{c} string" for c in QUEUE_COLUMNS))
    both = top.select(*QUEUE_COLUMNS, F.lit(0).alias("_m")).unionByName(monitor.withColumn("_m", F.lit(1)))
    # The window runs over at most max_items + 1 rows.
    n_real = F.sum(1 - F.col("_m")).over(Window.partitionBy())
    return both.withColumn("_n", n_real).where((F.col("_m") == 0) | (F.col("_n") == 0)).drop("_m", "_n")


# --------------------------------------------------------------------- SC-10
def shift_report(sensor: DataFrame, production: DataFrame, scored: DataFrame, alerts: DataFrame,
                 issues: DataFrame, latest_scored: DataFrame, model_runs: DataFrame | None = None) -> DataFrame:
    """One-row shift handover summary (counts, mean health and RUL, anomaly count, latest time)."""
    def part(tag, df, health=None, rul=None, flag=None, ts=None):
        return df.select(
            F.lit(tag).alias("_tag"),
            (to_double(health) if health else F.lit(None).cast("double")).alias("_h"),
            (to_double(rul) if rul else F.lit(None).cast("double")).alias("_u"),
            (F.col(flag).cast("long") if flag else F.lit(None).cast("long")).alias("_f"),
            (F.col(ts).cast("timestamp") if ts else F.lit(None).cast("timestamp")).alias("_t"))

    u = (part("s", sensor).unionByName(part("p", production))
         .unionByName(part("x", scored, flag="anomaly_flag", ts="timestamp"))
         .unionByName(part("a", alerts)).unionByName(part("q", issues))
         .unionByName(part("l", latest_scored, health="health_score", rul="rul_estimate_hours")))
    if model_runs is not None:
        u = u.unionByName(part("m", model_runs))
    t = F.col("_tag")
    k = u.agg(
        F.count_if(t == "s").alias("sensor_readings"), F.count_if(t == "p").alias("production_events"),
        F.count_if(t == "x").alias("predictions"), F.count_if(t == "a").alias("anomaly_alerts"),
        F.count_if(t == "q").alias("data_quality_issues"), F.count_if(t == "m").alias("model_runs"),
        F.avg(F.when(t == "l", F.col("_h"))).alias("avg_health_score"),
        F.avg(F.when(t == "l", F.col("_u"))).alias("avg_rul_hours"),
        F.coalesce(F.sum(F.when(t == "x", F.coalesce(F.col("_f"), F.lit(0)))), F.lit(0).cast("long")).alias("_fl"),
        F.max(F.when(t == "x", F.col("_t"))).alias("latest_prediction_timestamp"))
    return (k.withColumn("anomaly_count", F.when(F.col("anomaly_alerts") > 0, F.col("anomaly_alerts"))
                         .otherwise(F.col("_fl"))).drop("_fl"))


# --------------------------------------------------------------------- AG-13
def output_validation(counts: dict[str, DataFrame], minimums: dict[str, int] | None = None) -> DataFrame:
    """Row count per named table and a PASS/FAIL check (count >= minimum, default 1).

    One tagged union and one aggregate: every table is counted in the same job.
    """
    minimums = minimums or {}
    u = None
    for name, df in counts.items():
        part = df.select(F.lit(name).alias("table_name"))
        u = part if u is None else u.unionByName(part)
    agg = u.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
    names = u.sparkSession.createDataFrame([(n, int(minimums.get(n, 1))) for n in counts],
                                           "table_name string, minimum long")
    out = names.join(agg, "table_name", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("long")))
    return out.withColumn("status", F.when(F.col("row_count") >= F.col("minimum"), F.lit("PASS"))
                          .otherwise(F.lit("FAIL")))


# --------------------------------------------------------------------- AG-14
def distribution(df: DataFrame, column: str) -> DataFrame:
    """Counts and shares of a categorical column (shift, failure mode, ...)."""
    c = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
