"""Substring dedup against a brute-force count of windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from millwright.llm import queries, substring

SF = "/root/testdata/sf0.001"


def brute(texts, window):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(d[i:i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - window + 1):
            if count[tuple(d[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(d), sum(gone), " ".join(w for w, g in zip(d, gone) if not g), gone))
    return out


def made(seed, n, words):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(words)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 40))] for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 30))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(parts))
    return texts + texts[:3] + [None, "", "   ", "é x " * 50, "a"]


@pytest.mark.parametrize("window,hot,words", [(10, 256, 400), (10, 2, 400), (4, 3, 4), (1, 256, 50), (35, 1, 2)])
def test_equals_brute_force(spark, window, hot, words):
    texts = made(window + hot, 60, words)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, kept string, n_words int")
    got = {r.doc_id: r for r in substring.remove_repeats(docs, window=window, hot=hot).collect()}
    assert len(got) == len(texts)
    for i, (n, removed, kept, gone) in enumerate(brute(texts, window)):
        r = got[i]
        assert (r.n_words, r.n_removed, r.kept) == (n, removed, kept)
        covered = [False] * n
        for s in r.spans:
            covered[s.start:s.end] = [True] * (s.end - s.start)
        assert covered == gone


def test_automaton_counts_and_statistics():
    rng = random.Random(5)
    seqs = [([rng.randint(0, 2) for _ in range(rng.randint(1, 25))], rng.randint(1, 3)) for _ in range(12)]
    a = substring.SuffixAutomaton()
    for s, times in seqs:
        a.add(s, times)
    a.close()
    subs = Counter()
    for s, times in seqs:
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                subs[tuple(s[i:j])] += times
    for s in [s for s, _ in seqs] + [[0, 1, 7, 1, 0]]:
        want = [max([0] + [e - i for i in range(e) if subs[tuple(s[i:e])] > 1]) for e in range(1, len(s) + 1)]
        assert a.matching_statistics(s) == want


def test_null_and_repeated_ids_and_empty(spark):
    text = " ".join("w%d" % i for i in range(40))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "x " + text), (2, "short")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_removed, r.kept) for r in substring.remove_repeats(docs).collect())
    assert got == [("1", 40, ""), ("1", 40, ""), ("2", 0, "short"), ("None", 40, "x")]
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    rng = random.Random(3)
    words = ["v%d" % rng.randint(0, 9999) for _ in range(30_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[20_000:20_100]))], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring.remove_repeats(docs).collect()} == {1: 100, 2: 100}


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in queries.op2_substring_dedup(spark, SF).collect()}
    want = brute([d.text for d in docs], 35)
    assert sum(w[1] for w in want) > 0
    for d, (n, removed, kept, _) in zip(docs, want):
        r = got[d.doc_id]
        assert (r.n_words, r.n_removed) == (n, removed)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
