"""Daily partial results equal the full read models after each day; marginals, sketches and issue details."""
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import ts
from millwright.ml import stats as st
from millwright.operators import daily, quality as q, readmodels as rm
from millwright.session import scratch_path

DAY = 24 * 60


def _rows(spark):
    rnd = random.Random(4)
    sensor = [(i, f"M{rnd.randint(1, 4)}" if i % 9 else None, f"L{rnd.randint(1, 2)}", ts(rnd.randint(0, 3 * DAY)) if i % 17 else None) for i in range(80)]
    production = [(i, f"L{rnd.randint(1, 3)}", ts(rnd.randint(0, 3 * DAY))) for i in range(60)]
    issue = [("gap", ts(rnd.randint(0, 3 * DAY))) for _ in range(20)]
    scored = [(i, f"M{rnd.randint(1, 5)}", ts(rnd.randint(0, 3 * DAY)), rnd.choice(["low", "high", "critical"]), rnd.random() * 100,
               rnd.choice([None, 5.0, 9.0]), rnd.randint(0, 1)) for i in range(50)]
    alert = [(ts(rnd.randint(0, 3 * DAY)),) for _ in range(7)]
    return (spark.createDataFrame(sensor, "id long, machine_id string, line_id string, timestamp timestamp"),
            spark.createDataFrame(production, "id long, line_id string, timestamp timestamp"),
            spark.createDataFrame(issue, "issue_type string, timestamp timestamp"),
            spark.createDataFrame(scored, "id long, machine_id string, timestamp timestamp, risk_level string, health_score double, "
                                          "rul_estimate_hours double, anomaly_flag int"),
            spark.createDataFrame(alert, "timestamp timestamp"))


def _same(a, b):
    a, b = a.collect(), b.collect()
    assert len(a) == len(b) == 1 and set(a[0].asDict()) == set(b[0].asDict())
    for k, v in a[0].asDict().items():
        assert v == b[0][k] or abs(v - b[0][k]) < 1e-9, k


def test_equal_to_the_full_read_models_after_each_day(spark):
    tables, root = _rows(spark), scratch_path(spark, "daily")
    day = F.coalesce(F.to_date("timestamp"), F.lit("2026-05-02").cast("date"))  # rows without a time come with the second day
    for d in range(4):
        today = F.date_add(F.lit("2026-05-01").cast("date"), d)
        daily.write_days(root, daily.partials(*[df.where(day == today) for df in tables]))
        sensor, production, issue, scored, alert = [df.where(day <= today) for df in tables]
        _same(daily.acquisition_status(spark, root), rm.acquisition_status(sensor, production, issue))
        latest = rm.latest_per_group(scored, ["machine_id"])
        _same(daily.executive_kpis(spark, root), rm.executive_kpis(sensor, production, latest, alert, scored))
        _same(daily.shift_counts(spark, root), rm.shift_report(sensor, production, scored, alert, issue, latest).drop("model_runs"))
    # a day that is computed again replaces itself
    daily.write_days(root, daily.partials(*[df.where(F.to_date("timestamp") == "2026-05-02") for df in tables]))
    _same(daily.acquisition_status(spark, root), rm.acquisition_status(*tables[:3]))


def test_marginals(spark):
    rows = [("a", "high")] * 3 + [("b", "high")] * 3 + [("c", "low"), (None, "low"), ("a", None)]
    got = {(r.level, r.issue_type, r.severity): (r.issue_count, r.type_rank) for r in rm.issue_marginals(
        spark.createDataFrame(rows, "issue_type string, severity string")).collect()}
    assert got[("total", None, None)] == (9, None) and got[("severity", None, "high")] == (6, None) and got[("severity", None, "unknown")] == (1, None)
    assert [got[("type", k, None)] for k in ("a", "b", "c", "unknown")] == [(4, 1), (3, 2), (1, 3), (1, 4)]
    assert got[("type_severity", "a", "high")] == (3, None) and len(got) == 1 + 3 + 4 + 5


def test_sketches_keep_their_rank_error(spark):
    """Ties, nulls, one huge value and very uneven days."""
    rnd = np.random.default_rng(2)
    x = np.r_[rnd.standard_normal(30_000), np.full(5_000, 0.25), [1e300]]
    day = np.r_[rnd.integers(0, 3, 30_000), np.full(5_001, 7)]
    df = spark.createDataFrame([(float(v), int(d)) for v, d in zip(x, day)] + [(None, 1)], "x double, d int").repartition(5)
    probs = [0.01, 0.25, 0.5, 0.6, 0.85, 0.99]
    values = st.sketch_quantiles(st.quantile_sketches(df, "x", ["d"]), probs)
    rows = st.rank_range(df, "x", values).collect()
    assert sorted(r.q for r in rows) == probs and {r.n for r in rows} == {35_001}
    for r in rows:
        assert r.below - st.SKETCH_RANK_ERROR <= r.q <= r.upto + st.SKETCH_RANK_ERROR


def test_details_of_different_rules(spark):
    rows = [('{"column":"torque","value":-1.5}',), ('{"missing_columns":["a","b"],"row_id":7}',), ("not json",), (None,), ('{"value":"text"}',)]
    df = q.with_details(spark.createDataFrame(rows, "details_json string"),
                        {"value": ("$.value", "double"), "second": ("$.missing_columns[1]", "string"), "row_id": ("$.row_id", "long")})
    assert [tuple(r)[1:] for r in df.collect()] == [(-1.5, None, None), (None, "b", 7), (None, None, None), (None, None, None), (None, None, None)]
