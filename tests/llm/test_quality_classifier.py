"""Quality classifier: held-out accuracy, co-training, and edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import quality

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    got = quality.score(docs, quality.train(docs, labels.where(~fold))).join(labels.where(fold), "doc_id").select(
        "quality", "toxic", "quality_keep").collect()
    good = [r.quality_keep for r in got if r.quality == 1 and r.toxic == 0]
    poor = [r.quality_keep for r in got if r.quality == 0]
    toxic = [r.quality_keep for r in got if r.toxic == 1]
    assert len(good) > 300 and sum(good) >= 0.99 * len(good)
    assert sum(poor) <= 0.03 * len(poor) and sum(toxic) <= 0.1 * len(toxic)


def rows(rng, n, flip):
    """Word slots, make-up and metadata of two classes; either view tells them apart."""
    out, y = [], []
    for i in range(n):
        c = i % 2
        words = np.unique(np.r_[rng.integers(1000, 9000, 30), 10 + c if rng.random() > flip else 10 + rng.integers(0, 2)]).astype(np.int32)
        meta = quality.meta_features("good" if c == (rng.random() > flip) else "bad", "en", 100)
        out.append((words, np.zeros(12), meta))
        y.append(float(c))
    return out, np.array(y)


def test_views_teach_one_another():
    rng = np.random.default_rng(3)
    labelled, y = rows(rng, 120, 0.0)
    pool, _ = rows(rng, 400, 0.0)
    test, want = rows(rng, 400, 0.05)
    aside = np.arange(120) % 4 < 2
    model = quality.co_train(labelled, y, aside, pool)
    both = model.scores([r[:2] for r in test], np.array([r[2] for r in test]))[2]
    assert ((both > 0.5) == want).mean() > 0.9
    given = [quality._confident(np.array([0.999, 0.5, 0.001, 0.99]), y, 0.98, 3, 3)]
    assert given[0][0].tolist() == [0, 3, 2] and given[0][1].tolist() == [1, 1, 0]


def test_one_class_gives_no_model():
    rng = np.random.default_rng(3)
    labelled, y = rows(rng, 40, 0.0)
    assert quality.co_train(labelled, np.ones(40), np.arange(40) % 4 == 0, []) is None
    assert quality.co_train([], np.zeros(0), np.zeros(0, bool), []) is None


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (None, 0, 1), (2, None, None), (99, 0, 0)]])
def test_edge_rows(spark, labels):
    docs = spark.createDataFrame([(1, "a b", "en", 3, 0.5), (1, "a b", "en", 3, 0.5), (2, None, None, None, 0.5), (None, "", "", 0, None),
                                  (3, "x " * 100_000, "en", 5, 0.1)], "doc_id long, text string, lang string, n_chars long, quality_score double")
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality.score(docs, quality.train(docs, frame)).collect()
    assert len(out) == 5 and all(r.quality_keep and r.quality_score is None for r in out)
    assert quality.score(docs.limit(0), None).count() == 0


def test_scored_rows_with_nulls(spark):
    rng = np.random.default_rng(3)
    labelled, y = rows(rng, 120, 0.0)
    model = quality.co_train(labelled, y, np.arange(120) % 4 < 2, [])
    docs = spark.createDataFrame([(1, None, None), (None, "", "x"), (2, "ok", None)], "doc_id long, text string, source string")
    out = quality.score(docs, model).collect()
    assert len(out) == 3 and all(0 <= r.quality_score <= 1 for r in out)


def test_repeated_rows_do_not_crowd_out_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "co_train", lambda labelled, y, aside, pool, *_: (
        [(r[0].tobytes(), r[1].tobytes()) for r in labelled], y.tolist(), aside.tolist(), {r.packed for r in pool.table.collect()}))
    made = [(i, f"text number {i} of many") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    fit = lambda rows: quality.train(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), labels, max_labelled=60)
    want = fit(made)
    assert len(want[0]) == 60
    assert fit([made[1]] * 900 + [made[70]] * 900 + made) == want


def test_the_table_gives_the_same_pseudo_labels_as_a_list(spark):
    """Every unlabelled row is looked at, over many tasks and with repeated rows; ties go by a checksum."""
    rng = np.random.default_rng(5)
    place = np.full(quality._SLOTS, -1, np.int16)
    candidates = np.arange(1000, 3000, dtype=np.int32)
    place[candidates] = np.arange(2000)
    packed = list({quality._pack(np.unique(rng.integers(0, 4000, 60)), rng.random(12), quality._meta_code(f"s{i % 5}", "en", i % 7), place)
                   for i in range(9000)})
    packed.sort(key=lambda x: (quality.zlib.crc32(x), x))
    rows = quality._unpack(packed, candidates)
    assert quality._pack(*rows[0][:2], [0, 0, 0], place)[:256 + 96] == packed[0][:256 + 96]
    text, meta = quality.TextView(candidates[:50], weights=rng.normal(0, 2, 63)), quality.MetaView(rng.normal(0, 3, quality._META_SLOTS + 4))
    table = spark.createDataFrame([(x,) for x in packed + packed[:500]], "packed binary").repartition(7)
    y = np.arange(2400) % 3 == 0
    args = (text, (1.0, 0.0), meta, (1.0, 0.1), y.astype(float), 0.9, 2, 3)
    got, want = quality.Pool(table, candidates).surest(*args), quality._surest_of(rows, *args)
    for (g, gy), (w, wy) in zip(got, want):
        assert len(gy) > 100 and gy.tolist() == wy.tolist()
        key = lambda rows: {(r[0].tobytes(), r[1].tobytes()) for r in rows}
        assert len(key(g) ^ key(w)) <= 4  # scores that differ past the ninth digit


def test_scoring_sends_each_text_once(spark, monkeypatch):
    """Rows go to Python and back whole, so a text beside its row would double what a task holds."""
    docs = spark.createDataFrame([(i, None if i == 3 else f"some words of text {i}", "web", "en", 20 + i) for i in range(1200)],
                                 "doc_id long, text string, source string, lang string, n_chars long").coalesce(1)
    model = quality.Model(quality.TextView(), quality.MetaView(), (1.0, 0.0), (1.0, 0.0), np.array([1.0, 1.0, 0.0]))
    model.text.weights = np.linspace(-1, 1, model.text.weights.size)
    sent = []
    map_in_arrow = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **k: (sent.append(self.schema), map_in_arrow(self, *a, **k))[1])
    out = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(sent) == 1 and sent[0].simpleString().count("text:string") == 1
    for i in (0, 3, 499, 500, 1199):  # on both sides of a slice's end
        text = None if i == 3 else f"some words of text {i}"
        want = model.scores([quality.text_features(text)], quality.meta_features("web", "en", 20 + i)[None])
        assert out[i].text == text and [out[i].quality_text, out[i].quality_meta, out[i].quality_score] == pytest.approx([float(x[0]) for x in want])
