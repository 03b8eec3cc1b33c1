"""Substring dedup: removal of word spans that occur more than once in a corpus.

The corpus is its own reference, so one suffix automaton of it could neither
be built in one task nor broadcast.  It is cut into shards such that equal
windows always meet in one shard:

1. A window of ``window`` words is named by its anchor, the least hash of its
   ``ANCHOR_WORDS``-grams.  Consecutive windows with one anchor form a segment.
2. Anchors that stand at one place of the corpus have no repeated window and go.
3. The segments of an anchor, copies counted but held once, are a reference
   shard.  Its suffix automaton, with the number of occurrences of every
   state, is built in the task that the shard is sent to, and the shard's
   segments are streamed through it: the matching statistic of a word is the
   length of the longest match ending there that occurs twice.  Where it
   reaches the window length, a maximal span above the threshold is covered.
4. An anchor with more than ``hot`` occurrences may be in a third of all
   documents.  Its segments are never gathered: their windows are counted one by one by a 128-bit
   digest, with a map-side combine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW_KEY, binary_column, materialize, with_row_key

WINDOW = 35
#: Words whose hash may name a window.  Shorter windows than this many words are named by one word.
ANCHOR_WORDS = 8
#: Occurrences of an anchor up to which its segments form a shard.
HOT = 256
_CACHE_WORDS = 400_000
_SEGMENT = "struct<start:int,n:int,d1:bigint,d2:bigint,shard:bigint,words:binary>"


class _Hashes(dict):
    """Word to 64-bit hash; words beyond the cache's size are hashed anew."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < _CACHE_WORDS:
            self[word] = h
        return h


_HASHES = _Hashes()
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache
def _weights(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _grams(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on."""
    out = np.zeros(words.size - n + 1, np.uint64)
    for j, c in enumerate(_weights(n, seed)):
        out += words[j:j + out.size] * c
    return _mixed(out)


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:x.size - (n - width)], x[n - width:]) if n > width else x


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def segments(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows) of each run of windows with one anchor, and all gram hashes."""
    if hashes.size < window:
        return (np.zeros(0, np.int64),) * 4
    n = min(ANCHOR_WORDS, max(1, window // 2))
    grams = _grams(hashes, n, 1)
    anchors = _sliding_min(grams, window - n + 1)
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    return anchors[first].view(np.int64), first, np.diff(first, append=anchors.size), grams.view(np.int64)


def anchor_counts(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, places) of each segment: at how many places of the segment its anchor stands.

    A window that is repeated within one segment has its anchor at two places,
    so an anchor that stands at one place in the corpus has no repeated window.
    """
    anchor, first, count, grams = segments(hashes, window)
    if not anchor.size:
        return anchor, anchor
    n = min(ANCHOR_WORDS, max(1, window // 2))
    width = count + (window - n)  # grams that the segment covers
    start = np.cumsum(width) - width
    at = np.arange(int(width.sum())) - np.repeat(start - first, width)
    same = grams[at] == np.repeat(anchor, width)
    return anchor, np.add.reduceat(same.astype(np.int64), start)


# -- the automaton -----------------------------------------------------------

class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the occurrences of each state."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, follow: dict) -> int:
        self.next.append(follow)
        self.link.append(0)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, word, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, times: int = 1) -> None:
        """Adds one sequence that occurs ``times`` times."""
        follow, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for word in words:
            q = follow[last].get(word)
            if q is not None:  # known from an earlier sequence
                last = q if length[q] == length[last] + 1 else self._split(last, word, q)
            else:
                new = self._state(length[last] + 1, {})
                p = last
                while p != -1:
                    edges = follow[p]
                    if word in edges:
                        q = edges[word]
                        link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
                        break
                    edges[word] = new
                    p = link[p]
                last = new
            count[last] += times

    def close(self, least: int = 2) -> None:
        """Adds up occurrences, and finds for each state the longest suffix with ``least`` of them."""
        link, count = self.link, self.count
        order = sorted(range(1, len(link)), key=self.length.__getitem__)
        for s in reversed(order):
            count[link[s]] += count[s]
        self.known = known = [0] * len(link)
        for s in order:
            known[s] = s if count[s] >= least else known[link[s]]

    def matching_statistics(self, words: list) -> list[int]:
        """For each word, how many words up to it form the longest sequence known often enough.

        Words that the automaton does not know end the match, as in a stream of
        text that it was not built from.
        """
        follow, link, length, known = self.next, self.link, self.length, self.known
        out, s, n = [], 0, 0
        for word in words:
            q = follow[s].get(word)
            while q is None and s:
                s = link[s]
                n = length[s]
                q = follow[s].get(word)
            s, n = (q, n + 1) if q is not None else (0, 0)
            k = known[s]
            out.append(n if k == s else min(n, length[k]))
        return out


def repeated_windows(shard: list[tuple[list, int]], window: int) -> list[np.ndarray]:
    """For each (words, times) of a shard, which of its windows occur more than once in the shard."""
    if len(shard) == 1 and shard[0][1] > 1:  # only copies of one segment
        return [np.ones(len(shard[0][0]) - window + 1, bool)]
    automaton = SuffixAutomaton()
    for words, times in shard:
        automaton.add(words, times)
    automaton.close()
    return [np.array(automaton.matching_statistics(words)[window - 1:]) >= window for words, _ in shard]


# -- the job -----------------------------------------------------------------

def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   hot: int = HOT) -> DataFrame:
    """(id_col, n_words, n_removed, spans, kept): each document without its repeated spans.

    ``spans`` are the maximal runs of removed words as (start, end), end
    exclusive; ``kept`` is the other words joined by one space.  Words are what
    ASCII white space separates.  Null and empty texts have no words.  A row is
    a document: repeated rows repeat each other's text, and rows whose id is
    null or equal stay apart.  Other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = with_row_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"])

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, found, places = [], [], []
            for key, text in zip(b.column(0).to_pylist(), binary_column(b, "text")):
                if text:
                    a, n = anchor_counts(word_hashes(text.split()), window)
                    a, of = np.unique(a, return_inverse=True)  # a row for each anchor of the document
                    keys.append(np.full(a.size, key, np.int64))
                    found.append(a)
                    places.append(np.bincount(of, n, a.size).astype(np.int64))
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or none)) for x in (keys, found, places)],
                                             [ROW_KEY, "anchor", "places"])

    named = materialize(keyed.select(ROW_KEY, "text").mapInArrow(anchors, f"{ROW_KEY} long, anchor long, places long"), "anchors")
    often = named.groupBy("anchor").agg(F.sum("places").alias("n")).where("n > 1").select("anchor", (F.col("n") > hot).alias("hot"))
    lists = named.select(ROW_KEY, "anchor").join(often, "anchor").groupBy(ROW_KEY).agg(
        F.collect_list(F.when(~F.col("hot"), F.col("anchor"))).alias("cold"),
        F.collect_list(F.when(F.col("hot"), F.col("anchor"))).alias("hot"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()),
                                  ("shard", pa.int64()), ("words", pa.binary())]))
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                n_words, flat, out = [], [], []
                for text, cold, warm in zip(binary_column(b, "text"), b.column(3).to_pylist(), b.column(4).to_pylist()):
                    words = text.split() if text else []
                    n_words.append(len(words))
                    flat.append(b" ".join(words))
                    out.append(_cut(words, cold, warm, window) if cold or warm else [])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n_words, pa.int64()),
                     pa.array(flat, pa.binary()).cast(pa.string()), pa.array(out, seg)],
                    [ROW_KEY, "id", "n_words", "flat", "segs"])

    pieces = materialize(keyed.join(lists, ROW_KEY, "left").select(ROW_KEY, "id", "text", "cold", "hot").mapInArrow(
        cut, f"{ROW_KEY} long, id {id_type}, n_words long, flat string, segs array<{_SEGMENT}>"), "pieces")
    segs = pieces.select(ROW_KEY, F.explode("segs").alias("s")).select(ROW_KEY, "s.*")

    often = segs.where("shard is null").groupBy("d1", "d2").count().where("count > 1").select(
        "d1", "d2", F.unhex(F.lit("01")).alias("bits"))
    held = segs.where("shard is not null").groupBy("shard", "d1", "d2").agg(
        F.max("words").alias("words"), F.count("*").cast("int").alias("times"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], None

        def flush() -> pa.RecordBatch:
            got = repeated_windows([(w.split(b" "), t) for _, _, w, t in held], window)
            hit = [(a, b, np.packbits(r, bitorder="little").tobytes()) for (a, b, _, _), r in zip(held, got) if r.any()]
            return pa.RecordBatch.from_arrays([pa.array([h[i] for h in hit], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.binary()))], ["d1", "d2", "bits"])

        for b in batches:
            for s, d1, d2, words, times in zip(*[c.to_pylist() for c in b.columns]):
                if s != shard and held:
                    yield flush()
                    held = []
                shard = s
                held.append((d1, d2, words, times))
        if held:
            yield flush()

    # shards go whole to a task and follow one another there
    cold = held.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(match, "d1 long, d2 long, bits binary")
    hits = segs.select(ROW_KEY, "start", "d1", "d2").join(cold.union(often), ["d1", "d2"]).groupBy(ROW_KEY).agg(
        F.collect_list(F.struct("start", "bits")).alias("hits"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                removed, spans, kept = [], [], []
                for flat, hits in zip(binary_column(b, "flat"), b.column(3).to_pylist()):
                    if not hits:
                        removed.append(0)
                        spans.append([])
                        kept.append(flat)
                        continue
                    words = flat.split(b" ") if flat else []
                    gone = _covered(len(words), hits, window)
                    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                    removed.append(int(gone.sum()))
                    spans.append([{"start": i, "end": j} for i, j in edges.reshape(-1, 2).tolist()])
                    kept.append(b" ".join(compress(words, (~gone).tolist())))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(spans, span),
                     pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "spans", "kept"])

    schema = f"id {id_type}, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"
    touched = pieces.where(F.size("segs") > 0).select(ROW_KEY, "id", "n_words", "flat").join(hits, ROW_KEY, "left")
    untouched = pieces.where(F.size("segs") == 0).select(
        "id", "n_words", F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.col("flat").alias("kept"))
    return touched.select("id", "n_words", "flat", "hits").mapInArrow(remove, schema).union(untouched).withColumnRenamed(
        "id", id_col)


def _cut(words: list[bytes], cold: list[int] | None, hot: list[int] | None, window: int) -> list[dict]:
    """Segments of cold anchors with their words; single windows of hot ones with a digest alone."""
    hashes = word_hashes(words)
    anchor, first, count, _ = segments(hashes, window)
    out, cool = [], np.isin(anchor, np.array(cold or [], np.int64))
    for a, i, n in zip(*(x[cool].tolist() for x in (anchor, first, count))):
        text = b" ".join(words[i:i + n + window - 1])
        d = xxhash.xxh3_128_digest(text)
        out.append({"start": i, "n": n, "d1": int.from_bytes(d[:8], "little", signed=True),
                    "d2": int.from_bytes(d[8:], "little", signed=True), "shard": a, "words": text})
    if hot:
        warm = np.isin(anchor, np.array(hot, np.int64))
        at = np.concatenate([np.arange(i, i + n) for i, n in zip(first[warm], count[warm])])
        d1, d2 = (_grams(hashes, window, seed)[at].view(np.int64).tolist() for seed in (2, 3))
        out += [{"start": i, "n": 1, "d1": x, "d2": y, "shard": None, "words": None} for i, x, y in zip(at.tolist(), d1, d2)]
    return out


def _covered(n: int, hits: list[dict], window: int) -> np.ndarray:
    """Words that lie in a repeated window."""
    turn = np.zeros(n + 1, np.int32)
    for h in hits:
        at = h["start"] + np.flatnonzero(np.unpackbits(np.frombuffer(h["bits"], np.uint8), bitorder="little"))
        turn[at] += 1
        turn[at + window] -= 1
    return np.cumsum(turn[:n]) > 0
