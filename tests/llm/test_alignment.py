"""Tokenizer alignment against a plain version that tokenizes whole texts with the published libraries."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millwright.llm import alignment, queries

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def published():
    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)


@pytest.fixture(scope="module")
def own():
    with open(alignment.BYTE_BPE, "rb") as a, open(alignment.PIECE_BPE, "rb") as b:
        return alignment.Tokenizers(a.read(), b.read())


def plain_groups(published, text):
    """[(A ids, B ids)] of one text, or None if it isn't given back."""
    if not text:
        return None
    a, b = published
    of_char = alignment._byte_of_char()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(of_char[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    out, i, j = [], 0, 0
    for e in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(e) + 1, ends_b.index(e) + 1
        out.append((ids_a[i:k], ids_b[j:m]))
        i, j = k, m
    return out


def plain_rows(published, rows):
    groups = [plain_groups(published, t) for _, t in rows]
    links = Counter((g[0][-1], g[1][-1]) for gs in groups if gs for g in gs)
    most = {}
    for (_, b), n in links.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (i, _), gs in zip(rows, groups):
        if gs is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        own = [(g[0][-1], g[1][-1]) for g in gs]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in gs)
        out.append((i, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), len(own),
                    sum(links[p] == most[p[1]] for p in own), sum(links[p] for p in own), hashlib.sha256(text.encode()).hexdigest()))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()), key=str)


def test_registered_query(spark, published):
    """Every document of the smallest table."""
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.queries()["op12_tokenizer_alignment"](spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(plain_rows(published, rows))


TEXTS = [None, "", " ", "  ", "\n", "a ", " a", "a  b", "a\n b", "a \n  b\t", "trail  ", "x\r\n y", "▁", "a▁b", "a ▁", "naïve café", "日本語 テキスト",
         "😀 👍🏽", "\x00 \x7f", "<|endoftext|> <s> </s> <unk> <0x41>", "it's we'll", "　x 　y", "a\x85b c", "  double", "1234 56.78",
         "a" * 3000, "word " * 2000, "\x1c \x1d", "if (a) {\r\n return x_{1};\r\n}"]


def test_edge_texts(spark, published):
    """Null, empty, unusual and long texts, repeated rows, null and equal ids, clashing names."""
    rows = [(k if k % 7 else None, t) for k, t in enumerate(TEXTS)] + [(1, "word word"), (1, "word word"), (None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("pair", F.lit("x")).withColumn("id", F.lit(0.5))
    got, pairs = alignment.align(df, digest=True)
    assert rows_of(got) == sorted(plain_rows(published, rows), key=str)
    links = Counter((g[0][-1], g[1][-1]) for _, t in rows for g in plain_groups(published, t) or [])
    docs = Counter(p for _, t in rows for p in {(g[0][-1], g[1][-1]) for g in plain_groups(published, t) or []})
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in pairs.collect()} == {p: (docs[p], n) for p, n in links.items()}


def test_listed_groups(spark):
    got, _ = alignment.align(spark.createDataFrame([(1, "word"), (2, None)], SCHEMA))
    assert {r.doc_id: r.groups for r in got.collect()}.keys() == {1, 2} and "|" in got.where("doc_id = 1").first().groups


def test_empty_table(spark):
    got, pairs = alignment.align(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and pairs.collect() == []


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "  ", "\n", "the", "'s", "1", "é", "▁", "　", "\t", "_", "{", "\r", "ing", "日", "\x1d", ".", "Ba"]), max_size=14))
def test_units_are_exact(own, published, parts):
    """Cutting into units changes neither tokenizer's tokens."""
    text = "".join(parts)
    units = own.aligned([text])[0]
    want = plain_groups(published, text)
    if want is None:
        assert not units or not all(u[4] for u in units)
    else:
        assert ";".join(u[2] for u in units) == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in want)


def test_bitmaps():
    """Planes come back, sparse and dense; merging adds up documents of different parts."""
    rng = np.random.default_rng(1)
    docs = np.sort(rng.choice(alignment.CONTAINER, 30_000, replace=False))
    counts = rng.integers(1, 20, docs.size)
    half = rng.random(docs.size) < 0.5
    blob = alignment.merge([alignment.pack(docs[half], counts[half]), alignment.pack(docs[~half], counts[~half])])
    assert blob == alignment.pack(docs, counts)
    back = np.zeros(alignment.CONTAINER, np.int64)
    for k, plane in enumerate(alignment.unpack(blob)):
        back[plane] += 1 << k
    assert (back[docs] == counts).all() and back.sum() == counts.sum()


def test_flushes_are_merged(spark, monkeypatch, published):
    monkeypatch.setattr(alignment, "FLUSH_LINKS", 5)
    rows = [(k, f"the cat number {k % 3} sat sat sat") for k in range(200)]
    with open(alignment.BYTE_BPE, "rb") as a, open(alignment.PIECE_BPE, "rb") as b:
        files = type("Files", (), {"value": (a.read(), b.read())})
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([t for _, t in rows]), pa.array([k for k, _ in rows], pa.int64())],
                                       ["key", "text", "id"])
    out = pa.Table.from_batches(alignment._encode(files, pa.int64(), True)(iter([batch]))).to_pandas()
    raw = out[out.pair.notna()].astype({"pair": "int64", "container": "int64"}).sort_values(["pair", "container"])
    raw = pa.RecordBatch.from_pandas(raw[["pair", "container", "bitmaps", "n_docs", "n_links"]].astype({"n_docs": "int64", "n_links": "int64"}), preserve_index=False)
    merged = pa.Table.from_batches(alignment._merged(iter([raw]))).to_pandas()
    assert len(merged) < raw.num_rows and merged.n_links.sum() == 200 * len(plain_groups(published, rows[0][1]))
    for blob, n_docs in zip(merged.bitmaps, merged.n_docs):
        planes = alignment.unpack(blob)
        assert len(set(np.concatenate(planes).tolist())) == n_docs
