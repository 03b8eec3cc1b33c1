"""Language identification: held-out accuracy, and what has no language."""

import zlib

import numpy as np
import pytest

from millwright.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op10_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    held = [(got[d.doc_id].lang_pred, d.lang) for d in docs if got[d.doc_id].held_out]
    assert all(got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_slots_cover_the_whole_text():
    head = "ab " * 200_000
    assert set(langid.slots("zq")) <= set(langid.slots(head + "zq"))
    assert set(langid.slots(head)) == set(langid.slots("ab ab ab ab "))
    assert list(langid.slots("AB")) == list(langid.slots("ab"))


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, "the cat sat on the mat", "en", 0.5), (2, "le chat est sur la table", "fr", 0.5), (3, None, "en", None),
         (4, "12 !!", None, None), (5, "", "fr", None), (None, "the mat", None, None), (1, "the cat sat on the mat", "en", 1.0)],
        "doc_id long, text string, lang string, score double")
    got = sorted(map(tuple, langid.predict(docs, langid.train(docs)).collect()), key=str)
    by = [(i, p) for i, p, _ in got]
    assert by.count((1, "en")) == 2 and (2, "fr") in by and (None, "en") in by
    assert [(i, p, s) for i, p, s in got if i in (3, 4, 5)] == [(3, "und", 0.0), (4, "und", 0.0), (5, "und", 0.0)]


@pytest.mark.parametrize("rows", [[], [(1, "text", None)]])
def test_nothing_to_learn_from(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.predict(docs, langid.train(docs)).collect()] == ["und"] * len(rows)


def test_repeated_ids_do_not_fill_the_quota(spark, monkeypatch):
    monkeypatch.setattr(langid, "fit", lambda sets, langs, *_: sorted(zip(langs, map(tuple, sets))))
    made = [(i, "ab"[i % 2], f"text {chr(97 + i % 26)} {chr(97 + i // 26)}{chr(107 + i // 26)}") for i in range(100)]
    fit = lambda rows: langid.train(spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1), fit_rows=40)
    want = fit(made)
    assert len(want) == 40
    by = {tuple(langid.slots(t)): (i, n, t) for i, n, t in made}
    for lang in "ab":
        first = by[next(s for n, s in want if n == lang)]
        assert fit([first] * 500 + made) == want


def test_every_language_can_be_predicted(spark):
    """More languages than a share of the rows would give four texts to."""
    words = ["".join(chr(0x4E00 + 40 * k + j) for j in range(8)) for k in range(30)]
    docs = spark.createDataFrame([(6 * k + j, w[j % 3:], f"lang{k}") for k, w in enumerate(words) for j in range(6)],
                                 "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.train(docs, fit_rows=40)).join(docs, "doc_id").collect()
    assert len(got) == 180 and sum(r.lang_pred == r.lang for r in got) == 180


def test_kernel_and_predictions_against_exact_sets(spark):
    """Unhashed n-gram sets and a full kernel (every text a landmark), written out plainly."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and length(text) > 0").orderBy("doc_id").limit(160).collect()
    grams = []
    for d in docs:
        low = "".join(c if c.isalpha() else " " for c in d.text.lower())
        low = (" " if low[:1] == " " else "") + " ".join(low.split()) + (" " if low[-1:] == " " else "")
        grams.append({low[i:i + n] for n in (1, 2, 3, 4) for i in range(len(low) - n + 1)})
    exact = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in grams] for a in grams])
    x = langid.presence([langid.slots(d.text) for d in docs])
    # two sets meet in |a| |b| / SLOTS slots by chance, give or take the root of that (five of them are allowed)
    size = np.array([len(g) for g in grams], float)
    chance = np.sqrt(np.outer(size, size)) / langid.SLOTS
    assert (np.abs(x @ x.T - exact) <= chance + 5 / np.sqrt(langid.SLOTS)).all()
    fitted, rest = np.arange(0, 160, 2), np.arange(1, 160, 2)
    langs = [docs[i].lang for i in fitted]
    names = sorted(set(langs))
    model = langid.fit([langid.slots(docs[i].text) for i in fitted], langs, landmarks=len(fitted))
    got = [names[k] for k in model.scores([docs[i].text for i in rest]).argmax(1)]
    k = exact[np.ix_(fitted, fitted)]
    y = np.array([[1.0 if v == n else -1.0 for n in names] for v in langs])
    w = ((y > 0) / (y > 0).mean(0) / len(names)).sum(1)
    w /= w.sum()
    mean_k, mean_y = w @ k, w @ y
    centred = k - mean_k[None, :] - (k @ w)[:, None] + w @ k @ w
    alpha = np.linalg.solve(np.diag(w) @ centred + langid.RIDGE * np.eye(len(w)), np.diag(w) @ (y - mean_y))
    test = exact[np.ix_(rest, fitted)]
    scores = (test - mean_k[None, :] - (test @ w)[:, None] + w @ k @ w) @ alpha + mean_y
    want = [names[k] for k in scores.argmax(1)]
    assert sum(a == b for a, b in zip(got, want)) >= 0.97 * len(want)
