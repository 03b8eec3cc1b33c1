"""Near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, matrix, threshold=0.95):
    x = np.asarray(matrix, np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    low = np.array(ids)
    while True:
        new = np.minimum(low, np.where(near, low[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == low).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, near.sum(axis=1), low)}
        low = new


def clustered(rng, groups, singles, d=48, spread=0.12):
    out = []
    for size in groups:
        centre = rng.standard_normal(d)
        out += [centre + spread * rng.standard_normal(d) for _ in range(size)]
    out += list(rng.standard_normal((singles, d)))
    return np.array(out, np.float32)


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


@pytest.mark.parametrize("part_rows", [4096, 16])
def test_links_and_components(spark, part_rows):
    """Groups of near copies, exact copies and single vectors; large buckets in parts give the same."""
    rng = np.random.default_rng(3)
    x = clustered(rng, [40, 9, 3, 2], 300)
    x = np.concatenate([x, x[:5], x[:5], 2 * x[60:62]])
    ids = rng.permutation(len(x)).tolist()
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x)], SCHEMA)
    assert found(vectors.near_duplicates(df, part_rows=part_rows)) == brute(ids, x)


def test_recall_near_the_threshold(spark):
    """Pairs between 0.95 and 0.96, over enough rows for several bits: at least 0.99 of them are linked, and none below."""
    rng = np.random.default_rng(5)
    d, n = 32, 2500
    a = rng.standard_normal((n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r = rng.standard_normal((n, d))
    r -= (r * a).sum(axis=1, keepdims=True) * a
    r /= np.linalg.norm(r, axis=1, keepdims=True)
    cosine = rng.uniform(0.94, 0.96, n)[:, None]
    b = cosine * a + np.sqrt(1 - cosine**2) * r
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([a, b]))], "vec_id long, embedding array<double>, label int")
    got = found(vectors.near_duplicates(df))
    near = cosine[:, 0] >= 0.95
    linked = np.array([got[i][0] > 0 for i in range(n)])
    assert linked[near].mean() >= 0.99 and not linked[cosine[:, 0] < 0.9499].any()


def test_edge_rows(spark):
    """Null, empty and zero vectors, null and non-finite components, other lengths, null and repeated ids."""
    nan, inf = math.nan, math.inf
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0),
            (7, [1.0, 0.0], 0), (8, [1.0, -0.0], 1), (9, [1.0, 0.0, 0.0], 0), (None, [2.0, 0.0], 0), (10, [0.0, 1.0], None),
            (10, [0.0, 1.0], None), (None, [0.0, -5.0], 0), (11, [1.0, None], 0), (12, [1e-30, 0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("vid", F.lit(1)).withColumn("h1", F.lit(2)).withColumn("kept", F.lit(3))
    got = [tuple(r) for r in vectors.near_duplicates(df).collect()]
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 11)]
    want += [(7, 3, 7, True), (8, 3, 7, False), (12, 3, 7, False), (None, 3, 7, None), (10, 1, 10, True), (10, 1, 10, True), (None, 0, None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_units_and_table_plan():
    x = np.array([[1.0, 0.0], [1.0, 1e-9], [0.0, 1.0]])
    n, root = vectors.link_unit(x, np.array([1, 4, 1]), np.zeros((3, 2), np.int64), np.zeros(3, int), 0, 0.95)
    assert n.tolist() == [4, 1, 0] and root.tolist() == [0, 0, 2]
    # met in the table before
    n, root = vectors.link_unit(x, np.array([1, 4, 1]), np.zeros((3, 2), np.int64), np.zeros(3, int), 1, 0.95)
    assert n.tolist() == [0, 0, 0] and root.tolist() == [0, 1, 2]
    bits, tables = vectors.plan_tables(1)
    assert bits >= vectors.MIN_BITS and tables < vectors.plan_tables(10**9)[1] < 100
