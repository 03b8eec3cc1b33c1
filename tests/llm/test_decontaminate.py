"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

import pytest

from millwright.llm import decontaminate, queries

SF = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, window=10):
    windows = {}
    for k, (item, text) in enumerate(items):
        w = split(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add((k, item))
    lengths = {len(w) for w in windows}
    out = []
    for text in texts:
        w, hit, found = split(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((len(w), sorted(hit), sorted(str(i) for _, i in found if i is not None), len(found)))
    return out


@pytest.mark.parametrize("window,gram,vocabulary,seed", [(10, 5, 40, 1), (10, 5, 3, 2), (4, 2, 6, 3), (6, 6, 10, 4), (5, 1, 30, 5)])
def test_equals_brute_force(spark, window, gram, vocabulary, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "é", "9"]) + str(rng.randrange(vocabulary))
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 25)))) for i in range(12)]
    items += [(3, items[3][1]), (None, items[4][1]), (90, None), (91, "..."), (92, "zq zr")]
    texts = [None, "", "--", "zq ZR zq", "x " * 3000]
    for _ in range(40):
        w = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            src = split(rng.choice(items)[1])
            i = rng.randint(0, len(src))
            w[rng.randint(0, len(w)):0] = src[i:i + rng.randint(0, 14)]
        texts.append(rng.choice([" ", ", ", "\n"]).join(w).upper() if rng.random() < 0.3 else " ".join(w))
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, words string, n int")
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, words string")
    got = {r.doc_id: r for r in decontaminate.find(docs, bench, window=window, gram=gram).collect()}
    assert len(got) == len(texts)
    # upper() may change letters outside ASCII, so the brute force reads the very texts
    for i, (n, hits, ids, count) in enumerate(brute(texts, items, window)):
        assert (got[i].n_words, got[i].hits, got[i].items, got[i].n_items) == (n, hits, ids, count), i
        assert got[i].n_hit == len(hits)


def test_empty_tables_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "pre " + text)], "doc_id long, text string")
    bench = spark.createDataFrame([("i", text)], "item_id string, text string")
    got = decontaminate.find(docs, bench).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit) for r in got) == [("1", 12, 12), ("1", 12, 12), ("None", 13, 12)]
    assert decontaminate.find(docs.limit(0), bench).count() == 0
    assert [r.n_hit for r in decontaminate.find(docs, bench.limit(0)).collect()] == [0, 0, 0]


def test_shuffled_fingerprints_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    test_equals_brute_force(spark, 4, 2, 6, 7)


def test_no_python_in_the_plan(spark):
    plan = queries.op3_benchmark_decontamination(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in queries.op3_benchmark_decontamination(spark, SF).collect()}
    for d, (n, hits, ids, count) in zip(docs, brute([d.text for d in docs], items), strict=True):
        r = got[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hits), count, bool(hits))
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert any(r.contaminated for r in got.values())
