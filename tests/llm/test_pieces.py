"""Sampled segmentations against full enumeration; exact round trips."""

import math
from collections import Counter

import numpy as np
import pytest

from millwright.llm import pieces, queries


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


def enumerate_unit(v, unit):
    """All segmentations of a unit with their weights, by recursion."""
    if not unit:
        return [((), 0.0)]
    out = []
    for j in range(1, len(unit) + 1):
        k = v.spelled.get(unit[:j])
        if k is not None:
            out += [((k, *rest), v.weight[k] + w) for rest, w in enumerate_unit(v, unit[j:])]
    if unit[0] not in v.spelled:
        raw = tuple(v.byte_ids[b] for b in unit[0].encode())
        out += [((*raw, *rest), sum(v.weight[b] for b in raw) + w) for rest, w in enumerate_unit(v, unit[1:])]
    return out


def enumerate_text(v, text):
    all_ = [((), 0.0)]
    for unit in pieces.units(text):
        segs = enumerate_unit(v, unit)
        z = math.log(sum(math.exp(w) for _, w in segs))
        all_ = [(a + s, p + w - z) for a, p in all_ for s, w in segs]
    return dict(all_)


def draw(v, texts, k, keys=None):
    keys = np.arange(len(texts)) if keys is None else np.asarray(keys)
    return pieces.Sampler(pieces.Lattices(v), k)(texts, keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@pytest.mark.parametrize("text", ["the", "a b", "né!", "1 2", "x\n", "▁", "\U0001F600a"])
def test_all_segmentations_of_a_small_text(vocabulary, text):
    want = enumerate_text(vocabulary, text)
    got = draw(vocabulary, [text], len(want) + 5)[0]
    assert len(got) == len(want) and {tuple(g[0].tolist()) for g in got} == set(want)
    for ids, lp, _, score in got:
        assert lp == pytest.approx(want[tuple(ids.tolist())], abs=1e-9) and score == 0.0
    assert [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)


def test_without_replacement_distribution(vocabulary):
    text, n = "on to", 20_000
    p = {s: math.exp(lp) for s, lp in enumerate_text(vocabulary, text).items()}
    assert sum(p.values()) == pytest.approx(1)
    got = draw(vocabulary, [text] * n, 2)
    pairs = Counter((tuple(g[0][0].tolist()), tuple(g[1][0].tolist())) for g in got)
    assert all(a != b for a, b in pairs)
    for (a, b), c in pairs.most_common(6):
        want = p[a] * p[b] / (1 - p[a])
        assert c / n == pytest.approx(want, abs=5 * math.sqrt(want / n))
    # inclusion scores make sums over the whole set unbiased (Horvitz-Thompson)
    estimate = np.mean([sum(math.exp(lp - q) for _, lp, _, q in g) for g in got])
    assert estimate == pytest.approx(1, abs=0.05)


def test_a_row_does_not_depend_on_its_neighbours(vocabulary):
    texts = ["some words here", "été 12 — fin\n", "", "word " * 30]
    together = draw(vocabulary, texts, 3)
    for i, t in enumerate(texts):
        alone = draw(vocabulary, [t], 3, [i])[0]
        assert [(a[0].tolist(), a[1:]) for a in alone] == [(b[0].tolist(), b[1:]) for b in together[i]]


def test_round_trip_and_edge_rows(spark):
    texts = ["The cat.", "", None, "  two  spaces ", "a▁b", "tab\tnl\n\n", "日本 😀 é́", "x" * 5000, "the cat " * 4000, "%%% ###!!", "a"]
    rows = [(i, t, 1, "e") for i, t in enumerate(texts)] + [(0, texts[0], 1, "e"), (None, "null id", 1, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank int, ids string")
    got = pieces.sample_segmentations(docs, samples=3).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.rank, r.ids, r.log_prob, r.decoded) for r in by[2]] == [(0, None, None, None)]
    assert [(r.rank, r.ids, r.log_prob, r.log_inclusion, r.decoded) for r in by[1]] == [(1, [], 0.0, 0.0, "")]
    for i, t in enumerate(texts):
        if t:
            rs = sorted(by[i], key=lambda r: r.rank)
            assert all(r.decoded == t for r in rs)
            assert len({tuple(r.ids) for r in rs}) == len({r.rank for r in rs}) and rs[0].rank == 1
            assert all(r.log_inclusion <= 0 and r.log_prob <= 0 for r in rs)
    assert len(by[0]) == 6 and len(by[None]) == 3
    assert pieces.sample_segmentations(docs.limit(0)).count() == 0


def test_query_round_trips(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op1_sentencepiece_sampling(spark, sf).collect()
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.round_trip for r in got) and len({r.doc_id for r in got}) == n
    assert len(got) == 3 * n


def test_no_piece_crosses_units(vocabulary):
    assert [p for p in vocabulary.spelled if not pieces._UNIT.fullmatch(p)] == []
    rng = np.random.default_rng(5)
    spelled = list(vocabulary.spelled)
    for p in spelled:
        a, b = (spelled[i] for i in rng.integers(len(spelled), size=2))
        ends = np.cumsum([len(u) for u in pieces._UNIT.findall(a + p + b)])
        assert not ((ends > len(a)) & (ends < len(a) + len(p))).any(), (a, p, b)


@pytest.mark.parametrize("text", ["x_{", "{\r", "};\r\n"])
def test_pieces_of_marks_underscores_and_returns(vocabulary, text):
    """The segmentations are those of the text as a whole."""
    whole = enumerate_unit(vocabulary, " " + text)
    z = math.log(sum(math.exp(w) for _, w in whole))
    got = draw(vocabulary, [text], len(whole) + 5)[0]
    assert {tuple(g[0].tolist()): pytest.approx(g[1], abs=1e-9) for g in got} == {s: w - z for s, w in whole}
