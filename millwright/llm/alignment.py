"""Alignment of two tokenizers over a corpus by inverted bitmaps of token pairs.

1. Both tokenizers split each text; a group ends where tokens of both end, and
   the tokens that end there are linked.  A text is cut at spaces after other
   characters: no token of either vocabulary crosses such a place, so units
   that come again are aligned once.
2. Documents are numbered in containers of 65,536.  For each pair of linked
   tokens and container, the documents that hold the pair are bitmaps, one plane for
   each binary digit of how often they hold it; a plane is a sorted array or a
   bit string, whichever is smaller.
3. Bitmaps of a pair and container are OR-merged plane by plane.  Population
   counts give the pair's documents and, weighted by the digits, its links.
4. The postings are read back by container: each plane adds its pair's count to
   the scores of its documents.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import ROW_KEY, cut_lineage, materialize, with_row_key

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

#: Documents of a container, as bits of the row key.
CONTAINER_BITS = 16
CONTAINER = 1 << CONTAINER_BITS
#: Links that a task gathers before it writes their bitmaps.
FLUSH_LINKS = 4_000_000
#: Units whose alignment a worker keeps, and the longest that it keeps.
CACHE_UNITS = 300_000
CACHE_CHARS = 64
#: Units that are encoded as one text.
JOINED_UNITS = 1_024
#: Pairs up to which their counts are broadcast to the postings; more are shuffled.
BROADCAST_ROWS = 500_000

# Fixed value: the published pre-tokenization pattern of byte-level BPE.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Fixed value: the characters of Unicode's White_Space.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = frozenset(chr(c) for c in range(0x3001) if re.match(f"[{WHITE_SPACE}]", chr(c)))
_CUT = re.compile(rf"(?<=[^{WHITE_SPACE}]) (?!\Z)")


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE's alphabet: printable bytes stand for themselves, the others for characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, and the alignment of units of text.

    ``byte_bpe``: JSON of a byte-level BPE without normalizer, ids in the order of its merges.
    ``piece_bpe``: a SentencePiece model that adds a space in front.
    """

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        import sentencepiece
        import tiktoken

        spec = json.loads(byte_bpe)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (model["type"], pre["type"], pre["add_prefix_space"], spec["normalizer"]) != ("BPE", "ByteLevel", False, None):
            raise ValueError("the first tokenizer has to be a plain byte-level BPE")
        of_char = _byte_of_char()
        self.a_bytes = {i: bytes(map(of_char.__getitem__, t)) for t, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        first = len(model["vocab"]) - len(merges)
        if any(model["vocab"][x + y] != first + k for k, (x, y) in enumerate(merges)):
            raise ValueError("the first tokenizer's ids have to follow its merges")
        self.a = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, special_tokens={},
                                   mergeable_ranks={b: i for i, b in self.a_bytes.items()})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # a piece over a place of cutting would be lost
        self.cuts = not any(re.search(f"[^▁{WHITE_SPACE}]▁", p) for p in pieces)
        self.spelled = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.known: dict[str, tuple] = {}

    def units(self, text: str) -> list[str]:
        """The text in units, each without the space in front of it."""
        return _CUT.split(text) if self.cuts else [text]

    def _align_alone(self, unit: str) -> tuple:
        """(A tokens, B tokens, groups as text, codes of linked pairs, whether both give the unit's bytes)."""
        return self._align_all([unit]) or (0, 0, "", (), False)

    def _align_all(self, units: list[str]):
        """The alignments of several units, encoded as one text; of a single unit, its own.  None if their bytes aren't given back."""
        text = " ".join(units)
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        a_bytes, b_bytes = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        a_ends = np.cumsum(np.fromiter(map(len, a_bytes), np.int64, len(a)))
        b_ends = np.cumsum(np.fromiter(map(len, b_bytes), np.int64, len(b)))
        at = np.searchsorted(b_ends, a_ends)
        last_a = np.flatnonzero(b_ends[at] == a_ends)  # both texts end together, so every place is found
        last_b = at[last_a]
        spelled = self.spelled
        a_text, b_text = [spelled[i] for i in a], [spelled[i] for i in b]
        i = j = 0
        groups = []
        for k, m in zip((last_a + 1).tolist(), (last_b + 1).tolist()):
            groups.append(f"{a_text[i]}|{b_text[j]}" if k - i == m - j == 1 else f"{','.join(a_text[i:k])}|{','.join(b_text[j:m])}")
            i, j = k, m
        codes = (np.array(a, np.int64)[last_a] << 32 | np.array(b, np.int64)[last_b]).tolist()
        if len(units) == 1:
            return len(a), len(b), ";".join(groups), codes, True
        # a unit's end is the end of a group
        ends = np.cumsum(np.fromiter((len(u.encode()) + 1 for u in units), np.int64, len(units)))
        to = np.searchsorted(a_ends[last_a], ends)
        n_a, n_b = np.diff(last_a[to] + 1, prepend=0).tolist(), np.diff(last_b[to] + 1, prepend=0).tolist()
        cuts = [0, *(to + 1).tolist()]
        return [(x, y, ";".join(groups[f:e]), codes[f:e], True) for x, y, f, e in zip(n_a, n_b, cuts, cuts[1:])]

    def aligned(self, texts: list[str | None]) -> list[list[tuple]]:
        """The aligned units of each text; none for a null or empty text."""
        split = [self.units(t) if t else [] for t in texts]
        if len(self.known) > CACHE_UNITS:
            self.known = {}
        known, extra = self.known, {}
        new = list({u for units in split for u in units if u not in known})
        # in one text, units that can be followed by a cut are cut apart again
        regular = [u for u in new if 0 < len(u) <= CACHE_CHARS and u[-1] not in _SPACES] if self.cuts else []
        for at in range(0, len(regular), JOINED_UNITS):
            some = regular[at:at + JOINED_UNITS]
            if len(some) > 1 and (done := self._align_all(some)):
                known.update(zip(some, done))
        for u in new:
            if u not in known:
                (known if len(u) <= CACHE_CHARS else extra)[u] = self._align_alone(u)
        if extra:
            return [[known[u] if u in known else extra[u] for u in units] for units in split]
        return [list(map(known.__getitem__, units)) for units in split]


# -- bitmaps -----------------------------------------------------------------

def pack(docs: np.ndarray, counts: np.ndarray) -> bytes:
    """Planes of the binary digits of ``counts`` over sorted places of documents in a container."""
    out, digit = [], 0
    while True:
        rest = counts >> digit
        if not rest.any():
            return b"".join(out)
        plane = docs[(rest & 1).astype(bool)]
        if plane.size * 2 > CONTAINER // 8:
            bits = np.zeros(CONTAINER, np.uint8)
            bits[plane] = 1
            out.append(b"\xff\xff\xff\xff" + np.packbits(bits, bitorder="little").tobytes())
        else:
            out.append(plane.size.to_bytes(4, "little") + plane.astype("<u2").tobytes())
        digit += 1


def unpack(blob: bytes) -> list[np.ndarray]:
    """The planes' places of documents, lowest digit first."""
    planes, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 4], "little")
        if n == 0xFFFFFFFF:
            bits = np.unpackbits(np.frombuffer(blob, np.uint8, CONTAINER // 8, at + 4), bitorder="little")
            planes.append(np.flatnonzero(bits))
            at += 4 + CONTAINER // 8
        else:
            planes.append(np.frombuffer(blob, "<u2", n, at + 4).astype(np.int64))
            at += 4 + 2 * n
    return planes


def merge(blobs: list[bytes]) -> bytes:
    """OR of bitmaps over different documents, plane by plane."""
    docs = [np.concatenate([p for p in planes] or [np.zeros(0, np.int64)]) for planes in map(unpack, blobs)]
    weights = [np.concatenate([np.full(p.size, 1 << k) for k, p in enumerate(planes)] or [np.zeros(0, np.int64)]) for planes in map(unpack, blobs)]
    places, of = np.unique(np.concatenate(docs), return_inverse=True)
    return pack(places, np.bincount(of, np.concatenate(weights)).astype(np.int64))


ENCODED = ["key", "n_a", "n_b", "n_groups", "n_links", "groups", "container", "pair", "bitmaps", "n_docs", "id"]
ENCODED_DDL = ("key long, n_a long, n_b long, n_groups long, n_links long, groups string, container long, pair long, "
               "bitmaps binary, n_docs long, id ")


def _postings(codes: list[np.ndarray], places: list[np.ndarray], container: int, id_type: pa.DataType) -> pa.RecordBatch:
    """A row for each pair of one container: its bitmaps, documents and links."""
    code, place = np.concatenate(codes), np.concatenate(places)
    pairs, of = np.unique(code, return_inverse=True)
    held, counts = np.unique(of.astype(np.int64) << CONTAINER_BITS | place, return_counts=True)
    first = np.searchsorted(held >> CONTAINER_BITS, np.arange(pairs.size + 1))
    docs = held & (CONTAINER - 1)
    blobs = [pack(docs[s:e], counts[s:e]) for s, e in zip(first[:-1].tolist(), first[1:].tolist())]
    n, nothing = pairs.size, pa.nulls(pairs.size, pa.int64())
    return pa.RecordBatch.from_arrays(
        [nothing, nothing, nothing, nothing, pa.array(np.add.reduceat(counts, first[:-1])), pa.nulls(n, pa.string()),
         pa.array(np.full(n, container)), pa.array(pairs), pa.array(blobs, pa.binary()), pa.array(np.diff(first)), pa.nulls(n, id_type)], ENCODED)


_WORKER: dict[int, Tokenizers] = {}


def _worker_tokenizers(byte_bpe: bytes, piece_bpe: bytes) -> Tokenizers:
    """Tokenizers that outlive a task in the same Python worker; one pair of files at a time."""
    name = hash((byte_bpe, piece_bpe))
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = Tokenizers(byte_bpe, piece_bpe)
    return _WORKER[name]


#: Characters of text that are aligned at a time.
_SLICE_CHARS = 2_000_000


def _encode(files, id_type: pa.DataType, digest: bool):
    """(key, text, id) -> document rows (key set) and posting rows (pair set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _worker_tokenizers(*files.value)
        codes: list[np.ndarray] = []
        places: list[np.ndarray] = []
        container, links = -1, 0
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end] or "") <= _SLICE_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                rows = []
                for key, units in zip(keys[at:end], tokens.aligned(texts[at:end])):
                    n_a, n_b, groups, own, same = zip(*units) if units else ((), (), (), (), (False,))
                    if not all(same):
                        rows.append((0, 0, 0, ""))
                        continue
                    code, listed = np.fromiter(chain.from_iterable(own), np.int64), ";".join(groups)
                    rows.append((sum(n_a), sum(n_b), code.size, hashlib.sha256(listed.encode()).hexdigest() if digest else listed))
                    if codes and (key >> CONTAINER_BITS != container or links > FLUSH_LINKS):
                        yield _postings(codes, places, container, id_type)
                        codes, places, links = [], [], 0
                    container = key >> CONTAINER_BITS
                    codes.append(code)
                    places.append(np.full(code.size, key & (CONTAINER - 1)))
                    links += code.size
                n_a, n_b, n, groups = zip(*rows)
                size, none = len(rows), pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at:end], pa.int64()), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(groups, pa.string()), none, none, pa.nulls(size, pa.binary()), none,
                     b.column(2).slice(at, size)], ENCODED)
                at = end
        if codes:
            yield _postings(codes, places, container, id_type)
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (pair, container, bitmaps, n_docs, n_links) -> one row for each pair and container."""
    names = ["pair", "container", "bitmaps", "n_docs", "n_links"]
    held = None  # the last row, which may go on

    def row(pair, container, blobs, docs, links):
        return pair, container, blobs[0] if len(blobs) == 1 else merge(blobs), docs, links

    for b in batches:
        out = []
        for pair, container, blob, docs, links in zip(*(c.to_pylist() for c in b.columns)):
            if held is not None and held[:2] == (pair, container):
                held = (pair, container, [*held[2], blob], held[3] + docs, held[4] + links)
            else:
                if held is not None:
                    out.append(row(*held))
                held = (pair, container, [blob], docs, links)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == 2 else pa.int64()) for k, c in enumerate(zip(*out))], names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary() if k == 2 else pa.int64()) for k, c in enumerate(row(*held))], names)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(container, bitmaps, count, best) sorted by container -> (key, n_best, count_sum) of every document with links."""
    now, best, total = None, None, None

    def rows() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array((now << CONTAINER_BITS) + at), pa.array(best[at]), pa.array(total[at])],
                                          ["key", "n_best", "count_sum"])

    for b in batches:
        for container, blob, count, is_best in zip(*(c.to_pylist() for c in b.columns)):
            if container != now:
                if now is not None:
                    yield rows()
                now, best, total = container, np.zeros(CONTAINER, np.int64), np.zeros(CONTAINER, np.int64)
            for digit, docs in enumerate(unpack(blob)):  # a plane has a document once
                total[docs] += count << digit
                if is_best:
                    best[docs] += 1 << digit
    if now is not None:
        yield rows()


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE,
          piece_bpe: str = PIECE_BPE, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents (id_col, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) and pairs (a, b, n_docs, n_links, best).

    ``groups`` lists the ids of both tokenizers, group by group (``a1,a2|b1;a3|b2,b3``);
    with ``digest`` it is the list's SHA-256, as the list is several times as
    long as the text.  A link's count
    is the number of links that hold its pair in the whole table; ``best`` pairs have the
    highest count of their B token, ties included.  Texts that are null,
    empty, or not given back byte for byte by both tokenizers have no tokens:
    zeros and an empty list.  Repeated rows and rows with equal or null ids
    count and stay on their own.  Other columns are ignored.
    """
    spark = docs.sparkSession
    contents = []
    for path in (byte_bpe, piece_bpe):
        with open(path, "rb") as f:
            contents.append(f.read())
    files = spark.sparkContext.broadcast(tuple(contents))  # two tokenizer files
    keyed = with_row_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"])
    id_type = docs.schema[id_col].dataType
    encoded = materialize(keyed.select(ROW_KEY, "text", "id").mapInArrow(
        _encode(files, to_arrow_type(id_type), digest), ENCODED_DDL + id_type.simpleString()), "encoded")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a pair that is everywhere is dealt out by container too
    raw = encoded.where("pair is not null").select("pair", "container", "bitmaps", "n_docs", "n_links")
    postings = materialize(raw.repartition(n, "pair", "container").sortWithinPartitions("pair", "container").mapInArrow(
        _merged, "pair long, container long, bitmaps binary, n_docs long, n_links long"), "postings")
    counts = postings.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    counts = cut_lineage(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    highest = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    pairs = counts.join(highest, "b").select("pair", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))
    small = F.broadcast if counts.count() <= BROADCAST_ROWS else lambda df: df
    found = postings.select("pair", "container", "bitmaps").join(
        small(pairs.select("pair", F.col("n_links").alias("count"), "best")), "pair")
    scores = found.select("container", "bitmaps", "count", "best").repartition(n, "container").sortWithinPartitions(
        "container").mapInArrow(_scored, "key long, n_best long, count_sum long")
    zero = F.lit(0).cast("long")
    rows = encoded.where("key is not null").select("key", "id", "n_a", "n_b", "n_groups", "n_links", "groups").join(scores, "key", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "groups",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))
    tokens = pairs.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"),
                          "n_docs", "n_links", "best")
    return rows, tokens
