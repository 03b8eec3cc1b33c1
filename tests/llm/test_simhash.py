"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from millwright.llm import simhash
from millwright.llm.components import connected_components


def reference_simhash(text, n=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reference_components(ids, fps, k):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= k:
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(i)
    return {ids[i]: min(ids[j] for j in g) for g in groups.values() for i in g}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B", "É é İ x y z", "a a a a a a", "x y z w " * 50])
def test_fingerprint(text):
    got = simhash.simhash(None if text is None else text.encode())
    assert got == reference_simhash(text)


@pytest.mark.parametrize("unit_rows", [50_000, 7])
@pytest.mark.parametrize("max_bits", [3, 1])
def test_links_equal_brute_force(spark, unit_rows, max_bits):
    rng = random.Random(1)
    fps = [0]
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            fps.append(base)
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, max_bits + 1)))
    fps = sorted(set(fps))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    got = connected_components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bits, unit_rows))
    got = {r.node: r.component for r in got.collect()}
    want = reference_components(signed, fps, max_bits)
    assert {f: got.get(f, f) for f in signed} == want


def test_documents(spark):
    rng = random.Random(2)
    words = ["w%d" % i for i in range(300)]
    rows = [(1, None), (2, ""), (3, "  \t"), (4, "one"), (4, "one"), (5, "ONE"), (None, "one"), (6, "x " * 30_000)]
    for i in range(10, 30):
        text = [rng.choice(words) for _ in range(400)]
        rows.append((i, " ".join(text)))
        text[5] = "changed"
        rows.append((i + 100, " ".join(text)))
    docs = spark.createDataFrame([(i, t, "s", -1) for i, t in rows], "doc_id long, text string, fp string, component long")
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert len(got) == len(rows)
    ids = [i if i is not None else 10**9 for i, _ in rows]
    fps = [reference_simhash(t) for _, t in rows]
    want = reference_components(list(range(len(rows))), fps, 3)
    groups = {}
    for i, root in want.items():
        groups.setdefault(root, []).append(ids[i])
    expected = sorted((ids[i], int(np.uint64(fps[i]).astype(np.int64)), min(groups[r])) for i, r in want.items())
    assert sorted((i if i is not None else 10**9, f, c) for i, f, c in got) == expected


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3), (9, 8), (8, 9)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]} | {8: 8, 9: 8}
