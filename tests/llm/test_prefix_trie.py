"""The conversation trie against a plain version, over small and skewed tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    """Nodes by walking every opening of every rebuilt conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said = (role or "", text or "")
            digest = hashlib.md5(f"{len(said[0].encode())}:{said[0]}{said[1]}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, said))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        block = c - int(np.fmod(c, 5))
        path = tuple(own.get(block, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not kids[p]
        saved[p] += (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def rows_of(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*COLUMNS).collect())


def made(n, seed, deep=()):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(deep[c] if c < len(deep) else rng.randint(1, 6)):
            # a third of all begin alike, and texts are few, so openings are shared
            text = "hello" if t == 0 and rng.random() < 0.4 else rng.choice(["a", "b", "é", "", None, "long " * 3])
            rows.append((c, t, rng.choice(["user", "user", None]), text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_version(spark, seed):
    rows = made(300, seed)
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert rows_of(got) == plain_trie(rows)


def test_small_stretches(spark):
    """Nodes over the edges of parts and of Arrow batches, and many copies of one conversation."""
    rows = made(120, 9, deep=(40, 40, 1, 0, 33))
    rows += [(c, t, "user", f"turn {t}") for c in range(1000, 1400, 5) for t in range(3)]
    rows += [(c, t, "user", f"turn {t}") for c in range(2000, 2050, 5) for t in range(60)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = rows_of(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == plain_trie(rows)


def test_edge_rows(spark):
    """Null ids, turns, roles and texts, equal turn numbers, repeated rows, negative ids, a very long text, other columns."""
    rows = [(None, 0, "user", "x"), (1, None, "user", "first"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
            (-3, 1, None, None), (-5, 0, "", ""), (7, 3, "user", "y" * 300_000), (5, 3, "user", "y" * 300_000),
            (2**62, 0, "user", "z"), (4, 0, "us", "erx"), (9, 0, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("?")).withColumn("path", F.lit(3)).withColumn("rec", F.lit(1))
    assert rows_of(prefix_trie.conversation_trie(df)) == plain_trie(rows)


def test_empty_table(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []


def test_depth_is_exact_for_a_long_shared_opening():
    record = lambda k: hashlib.md5(str(k).encode()).digest() + (5).to_bytes(4, "big")
    path = b"".join(map(record, range(500)))
    batches = list(prefix_trie.peel([path, path, path + record("x")], np.array([4, 9, 2]), -1, -1))
    nodes = [r for b in batches for r in b.to_pylist()]
    assert len(nodes) == 502 and {r["n_convs"] for r in nodes if r["depth"] <= 500} == {3}
    root = next(r for r in nodes if r["depth"] == 0)
    assert (root["conv_id"], root["n_leaves"], root["saved_tokens"]) == (2, 1, 500 * 2 * 5)
