"""SimHash near-duplicates: fingerprints, and a self-join of them on a binary trie.

The trie of all fingerprints is walked as pairs of nodes: a pair of nodes at
the same depth stands for all pairs of fingerprints below them and carries the
number of bits in which their paths differ; a pair over the error budget is
pruned with everything below it.

To share the walk out over executors, the trie is built several times with its
bits in different orders.  With ``max_bits`` differing bits spread over
``blocks`` blocks, at least ``blocks - max_bits`` blocks agree, so every
linked pair lies below one node at the depth of those blocks in one of the
orders.  Those nodes are the units that are shuffled; within one, all orders
and depths below it are walked with the full error budget, so no pair within
the budget is lost.  The number of blocks follows from the number of
fingerprints, so that units stay small at any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, cut_lineage
from .components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
#: Fingerprints of one unit of the walk; a larger unit is walked as pairs of parts.
UNIT_ROWS = 50_000
#: Node pairs expanded at a time.
FRONTIER = 1_000_000
BITS = 64


def simhash(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of UTF-8 text over word shingles, repeats included; 0 without words.

    ASCII letters are lower-cased and words are what ASCII white space
    (space, tab to carriage return) separates, as ``bytes`` does both.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = [0, *(ends[:-shingle_words] + 1).tolist()]
    last = ends[shingle_words - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(flat[i:j], HASH_SEED) for i, j in zip(first, last)), np.uint64, len(first))
    votes = np.zeros(BITS, np.int64)
    for at in range(0, hashes.size, 1 << 14):
        octets = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > hashes.size, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id_col, fp): the SimHash of every text as a signed 64-bit number."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((simhash(t, shingle_words) for t in binary_column(b, "text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, fp long").withColumnRenamed("id", id_col)


# -- the trie ----------------------------------------------------------------

def _orders(blocks: int, max_bits: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each choice of agreeing blocks: the blocks as (low bit, width), agreeing ones first, and their bits."""
    cut = [BITS * i // blocks for i in range(blocks + 1)]
    spans = [(cut[i], cut[i + 1] - cut[i]) for i in range(blocks)]
    out = []
    for agree in combinations(range(blocks), blocks - max_bits):
        rest = [i for i in range(blocks) if i not in agree]
        out.append(([spans[i] for i in (*agree, *rest)], sum(spans[i][1] for i in agree)))
    return out


def _reorder(fp: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros_like(fp)
    for low, width in spans:
        part = (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)
        out = (out << np.uint64(width)) | part if width < BITS else part
    return out


def _blocks_for(n: int, max_bits: int, unit_rows: int) -> int:
    """Fewest blocks whose agreeing bits cut ``n`` evenly spread fingerprints into units of a tenth of the bound."""
    for blocks in range(max_bits + 1, max_bits + 5):
        if n / 2 ** (BITS * (blocks - max_bits) / blocks) <= unit_rows / 10:
            return blocks
    return max_bits + 4


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    r = parent[x]
    while True:
        up = parent[r]
        if np.array_equal(up, r):
            return r
        r = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while a.size:
        ra, rb = _find(parent, a), _find(parent, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def walk(values: np.ndarray, unit: np.ndarray, depth: int, max_bits: int, step: int = 4) -> np.ndarray:
    """Links fingerprints of equal ``unit`` within ``max_bits`` bits: for each row, the first row of its component.

    ``values`` are distinct within a unit, rows are sorted by (unit, value), and
    those of a unit agree in their first ``depth`` bits.  Pairs of trie nodes
    are expanded ``step`` levels at a time, breadth first in slices of the
    frontier, so memory stays bounded.
    """
    n = values.size
    parent = np.arange(n)
    new_unit = np.r_[True, unit[1:] != unit[:-1]] if n else np.zeros(0, bool)
    depths = [depth, *range(min(depth + step, BITS), BITS, step), BITS]
    starts, prefixes = [], []
    for d in depths:
        prefix = values >> np.uint64(BITS - d) if d else np.zeros_like(values)
        at = np.flatnonzero(new_unit | np.r_[True, prefix[1:] != prefix[:-1]]) if n else np.zeros(0, np.int64)
        starts.append(at)
        prefixes.append(prefix[at])
    children = [np.r_[np.searchsorted(starts[i + 1], starts[i]), starts[i + 1].size] for i in range(len(depths) - 1)]
    # nodes with a single fingerprint below them need no walk of their own
    sizes = np.diff(np.r_[starts[0], n])
    roots = np.flatnonzero(sizes > 1)
    stack = [(0, roots, roots, np.zeros(roots.size, np.int64))]
    while stack:
        level, a, b, bits = stack.pop()
        if level == len(depths) - 1:
            apart = a != b
            _unite(parent, a[apart], b[apart])
            continue
        first, count = children[level][:-1], np.diff(children[level])
        na, nb = count[a], count[b]
        made = na * nb
        total = np.cumsum(made)
        if a.size > 1 and total.size and total[-1] > FRONTIER:
            cut = max(1, int(np.searchsorted(total, total[-1] // 2)))
            stack += [(level, a[cut:], b[cut:], bits[cut:]), (level, a[:cut], b[:cut], bits[:cut])]
            continue
        of = np.repeat(np.arange(a.size), made)
        k = np.arange(of.size) - np.repeat(total - made, made)
        ca, cb = first[a][of] + k // nb[of], first[b][of] + k % nb[of]
        twice = (a[of] == b[of]) & (ca > cb)
        differ = np.bitwise_count(prefixes[level + 1][ca] ^ prefixes[level + 1][cb]).astype(np.int64)
        # prefixes are cumulative, so the popcount is that of all bits walked below the unit
        within = (differ <= max_bits) & ~twice
        stack.append((level + 1, ca[within], cb[within], differ[within]))
    return _find(parent, np.arange(n))


def links(fps: DataFrame, max_bits: int = MAX_BITS, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(a, b): links that join up exactly the fingerprints within ``max_bits`` differing bits of one another.

    ``fps`` has one distinct non-null ``fp`` column.  What a unit sends on is a
    forest (each fingerprint to the first one of its component in the unit),
    never all pairs.
    """
    spark = fps.sparkSession
    fps = cut_lineage(fps.select("fp"))
    blocks = _blocks_for(fps.count(), max_bits, unit_rows)
    orders = _orders(blocks, max_bits)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for k, (spans, depth) in enumerate(orders):
                v = _reorder(fp, spans)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(fp.size, k, np.int32)), pa.array((v >> np.uint64(BITS - depth)).view(np.int64)),
                     pa.array(fp.view(np.int64))], ["ord", "node", "fp"])

    placed = fps.mapInArrow(spread, "ord int, node long, fp long")
    large = placed.groupBy("ord", "node").count().where(F.col("count") > unit_rows)
    parts = F.coalesce(F.ceil(F.col("count") / unit_rows), F.lit(1)).cast("int")
    placed = placed.join(large, ["ord", "node"], "left").withColumn("parts", parts)
    # a large unit is cut into parts by hash, and each pair of parts is walked
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda p: F.least(p, own) * F.col("parts") + F.greatest(p, own))
    placed = placed.select("ord", "node", F.explode(pairs).alias("part"), "fp")

    def walk_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(rows: np.ndarray) -> pa.RecordBatch:
            unit = np.cumsum(np.r_[False, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
            out_a, out_b = [], []
            for k in np.unique(rows[:, 0]):
                spans, depth = orders[int(k)]
                own = rows[:, 0] == k
                fp, u = np.ascontiguousarray(rows[own, 3]).view(np.uint64), unit[own]
                v = _reorder(fp, spans)
                by = np.lexsort((v, u))
                fp, v, u = fp[by], v[by], u[by]
                root = walk(v, u, depth, max_bits)
                joined = root != np.arange(root.size)
                out_a.append(fp[joined])
                out_b.append(fp[root[joined]])
            a, b = np.concatenate(out_a).view(np.int64), np.concatenate(out_b).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            rows = np.concatenate([*held, rows])
            # the last unit may go on in the next batch
            same = (rows[:, :3] == rows[-1, :3]).all(axis=1)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield flush(rows[:cut])
            held = [rows[cut:]]
        if held and held[0].size:
            yield flush(held[0])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(n, "ord", "node", "part").sortWithinPartitions("ord", "node", "part").mapInArrow(
        walk_units, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(id_col, fp, component_id): each row's SimHash and the smallest id it is linked to, directly or not.

    Null and empty texts have fingerprint 0 and are linked like any other.
    Repeated rows and equal ids stay as rows of their own.  A null id never
    names a component unless all its members' ids are null.  An empty table
    gives an empty result.  Other columns of ``docs`` are ignored.
    """
    marked = cut_lineage(fingerprints(docs, id_col, text_col, shingle_words))
    by_fp = cut_lineage(marked.groupBy("fp").agg(F.min(id_col).alias("low")))
    groups = connected_components(links(by_fp.select("fp"), max_bits, unit_rows))
    named = by_fp.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    of_fp = named.join(lowest, "component").select("fp", "component_id")
    return marked.join(of_fp, "fp").select(id_col, "fp", "component_id")
