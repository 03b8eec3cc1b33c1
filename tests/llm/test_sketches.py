"""Bottom-k sketches: estimates against sets, and the edited texts against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from millwright.llm import queries, sketches

SF = "/root/testdata/sf0.001"


def shingles(text, n=5):
    w = (text or "").split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def test_estimates(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for share in (0.0, 0.3, 0.7, 1.0):
        a = [rng.choice(words) for _ in range(3000)]
        b = a[:int(3000 * share)] + [rng.choice(words) for _ in range(3000 - int(3000 * share))]
        rows.append((" ".join(a), " ".join(b)))
    rows += [("one two", "one two"), ("", None), ("a b c d e f", "a b c d e"), ("", "x"), ("x " * 5000, "x x x x x")]
    df = spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], "i int, a string, b string, sa string")
    df = sketches.with_sketch(sketches.with_sketch(df, "a", "sa"), "b", "sb")
    a, b = F.col("sa"), F.col("sb")
    got = df.select("i", sketches.resemblance(a, b).alias("r"), sketches.containment(a, b).alias("c"),
                    sketches.distinct(a).alias("d"), F.size("sa").alias("n")).collect()
    for g in got:
        x, y = shingles(rows[g.i][0]), shingles(rows[g.i][1])
        exact = max(len(x), len(y)) < sketches.K
        near = 1e-12 if exact else 0.15
        assert g.r == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0, abs=near)
        assert g.c == pytest.approx(len(x & y) / len(x) if x else 1.0, abs=1e-12 if exact else 0.25)
        assert g.d == pytest.approx(len(x), rel=1e-12 if exact else 0.3)
        assert g.n == min(len(x), sketches.K)


def test_merging_parts_equals_the_whole(spark, monkeypatch):
    monkeypatch.setattr(sketches, "_FAN_IN", 4)
    rng = random.Random(2)
    parts = [(g, " ".join(f"v{rng.randrange(300)}" for _ in range(40))) for g in "aaaaaaaaaaaaaaaaaaaaab" for _ in range(2)] + [("c", None)]
    df = sketches.with_sketch(spark.createDataFrame(parts, "g string, t string"), "t", "s", 50)
    got = {r.g: r.s for r in sketches.merge_groups(df, ["g"], "s", 50).collect()}
    whole = df.select("g", F.explode_outer("s").alias("h")).groupBy("g").agg(F.sort_array(F.collect_set("h")).alias("s")).collect()
    assert got == {r.g: r.s[:50] for r in whole}


def edit(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 2
        out.append((i, len(t), t[:len(t) - n] + after[:n], t, after))
    return out


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_edited_texts(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [(5, "été 😀 four"), (3, None), (9, ""), (None, "null id text"), (-1, "a"), (7, "x " * 50_000), (8, "same"), (10, "same"), (11, "zz yy")]
        df = spark.createDataFrame([(i, t, 7, "e") for i, t in rows], "doc_id long, text string, n_chars int, edited string").repartition(3)
        df = spark.createDataFrame(df.collect(), df.schema)
        got = {r.doc_id: r for r in sketches.edited_fingerprints(df).collect()}
        assert len(got) == len(rows)
        for i, n, edited, text, after in edit(rows):
            r = got[i]
            assert (r.n_chars, r.edited) == (n, edited)
            assert len(r.sketch) == len(shingles(text)) and len(r.next_sketch) == len(shingles(after))
        assert got[8].sketch == got[10].sketch
        lone = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
        assert [r.edited for r in sketches.edited_fingerprints(lone).collect()] == ["abab"]
        twice = spark.createDataFrame([(1, "abcd"), (1, "efgh")], "doc_id long, text string").coalesce(1)
        assert sorted(r.edited for r in sketches.edited_fingerprints(twice).collect()) == ["abef", "efab"]
        assert sketches.edited_fingerprints(lone.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = queries.op5_document_fingerprints(spark, SF)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == len(docs)
    for i, n, edited, text, after in edit(docs):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = shingles(text), shingles(edited), shingles(after)
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b), abs=0.2)
        assert r.near_next == pytest.approx(len(a & c) / len(a | c), abs=0.2)
    same = {}
    for i, t in docs:
        assert same.setdefault(t, got[i].fingerprint) == got[i].fingerprint
