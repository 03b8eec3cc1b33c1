"""Near-duplicate vectors by random-hyperplane sign hashing, exact cosines and connected components.

1. Equal vectors are one, with their number.
2. Each distinct vector gets a code in each of several tables: the signs of its
   products with random hyperplanes.  Vectors at an angle t agree in a bit with
   probability 1 - t/pi, so a pair at the threshold shares a bucket in some
   table with probability ``1 - (1 - p^bits)^tables``.  The number of bits
   grows with the logarithm of the rows, so buckets keep their size; the number
   of tables follows from the bits and the miss rate that is allowed.
3. A bucket is compared within itself by blocks of matrix products.  Products
   in single precision pass over what is clearly below the threshold; near it
   the cosine in double precision decides.  Each row carries its codes, so a pair is
   counted in the first table that it shares and in no other.
4. What leaves a bucket is a number of links for each vector and a forest, never pairs.
   Large buckets are cut into parts, and each pair of parts is a unit of work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW_KEY, cut_lineage, materialize, with_row_key
from .components import connected_components

THRESHOLD = 0.95
#: Share of the pairs right at the threshold that may share no bucket; pairs above it are missed less.
MISS = 0.001
SEED = 20_11
#: Vectors that a bucket has on average, if they are spread evenly.
BUCKET_ROWS = 1_024
#: Vectors of one unit's part; larger buckets are cut up.
PART_ROWS = 4_096
#: Rows of one matrix product.
BLOCK = 512
MIN_BITS = 4


def plan_tables(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for so many distinct vectors."""
    bits = max(MIN_BITS, round(math.log2(max(rows, 1) / BUCKET_ROWS)))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null or empty, all components finite, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) for each length among the lists."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        x = flat[starts[rows][:, None] + np.arange(d)]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
        out.append((rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
    return out


def _coded(distinct: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(vid, mult, v, codes): unit vectors with their bucket in every table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            for rows, x in _matrix(b.column(2)) if b.num_rows else []:
                d = x.shape[1]
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).standard_normal((d, tables * bits))
                signs = (x @ planes[d] > 0).reshape(-1, tables, bits)
                codes = signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at),
                     pa.ListArray.from_arrays(np.arange(rows.size + 1, dtype=np.int32) * d, pa.array(x.ravel())),
                     pa.ListArray.from_arrays(np.arange(rows.size + 1, dtype=np.int32) * tables, pa.array(codes.ravel()))],
                    ["vid", "mult", "v", "codes"])
    return distinct.select("vid", "mult", "v").mapInArrow(run, "vid long, mult long, v array<double>, codes array<long>")


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        x = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while a.size:
        a, b = _find(parent, a), _find(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def link_unit(x: np.ndarray, mult: np.ndarray, codes: np.ndarray, part: np.ndarray, table: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(number of links, root) of each row of one unit: unit vectors of a bucket, in one part or in two.

    Of two parts only pairs across them count: each part has a unit of its own.
    """
    n, d = x.shape
    single = x.astype(np.float32)
    margin = 4 * d * float(np.finfo(np.float32).eps)
    count, parent = np.zeros(n, np.int64), np.arange(n)
    two = part.min() != part.max()
    for at in range(0, n, BLOCK):
        i, j = np.nonzero(single[at:at + BLOCK] @ single[at:].T >= threshold - margin)
        i, j = i + at, j + at
        pair = i < j
        if two:
            pair &= part[i] != part[j]
        i, j = i[pair], j[pair]
        for k in range(table):  # counted there
            fresh = codes[i, k] != codes[j, k]
            i, j = i[fresh], j[fresh]
        # few are left that were not met in an earlier table, or the bucket is one of near copies
        sure = np.concatenate([np.einsum("ij,ij->i", x[i[s:s + 65_536]], x[j[s:s + 65_536]]) >= threshold
                               for s in range(0, i.size, 65_536)] or [np.zeros(0, bool)])
        i, j = i[sure], j[sure]
        count += np.bincount(i, mult[j], n).astype(np.int64) + np.bincount(j, mult[i], n).astype(np.int64)
        _unite(parent, i, j)
    return count, _find(parent, np.arange(n))


LINKED = "a long, b long, n long"


def _link_buckets(threshold: float):
    """Sorted units -> (vid, null, links) and (vid, root, 0)."""
    def unit(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        vid, mult, own = (t[c].to_numpy() for c in ("vid", "mult", "own"))
        x = t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        codes = t["codes"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        n, root = link_unit(x, mult, codes, own, int(t["tab"][0].as_py()), threshold)
        some, child = n > 0, root != np.arange(root.size)
        a, b = np.r_[vid[some], vid[child]], np.r_[np.zeros(int(some.sum()), np.int64), vid[root[child]]]
        return pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b, mask=np.arange(b.size) < some.sum()), pa.array(np.r_[n[some], np.zeros(int(child.sum()), np.int64)])],
            ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(k).to_numpy() for k in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                if held and tuple(keys[s]) != name:
                    yield unit(held)
                    held = []
                name = tuple(keys[s])
                held.append(b.slice(s, e - s))
        if held:
            yield unit(held)
    return run


def links(distinct: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, seed: int = SEED,
          part_rows: int = PART_ROWS) -> DataFrame:
    """(a, null, n): shares of a vector's number of links; (a, b, 0): a forest that joins up the linked vectors.

    ``distinct`` has (vid, mult, v) with different usable vectors.
    """
    spark = distinct.sparkSession
    bits, tables = plan_tables(distinct.count(), threshold, miss)
    coded = materialize(_coded(distinct, bits, tables, seed), "codes").withColumn("dim", F.size("v").cast("long"))
    spread = coded.select("vid", "mult", "v", "codes", "dim", F.posexplode("codes").alias("tab", "code")).withColumn("tab", F.col("tab").cast("long"))
    names = ["dim", "tab", "code"]
    large = cut_lineage(coded.select("dim", F.posexplode("codes").alias("tab", "code")).groupBy(*names).count().where(F.col("count") > part_rows))
    spread = spread.join(F.broadcast(large) if large.count() <= 100_000 else large, names, "left")
    parts = F.coalesce(F.ceil(F.col("count") / part_rows), F.lit(1)).cast("long")
    own = F.pmod(F.xxhash64("vid"), parts)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda p: F.least(p, own) * parts + F.greatest(p, own))
    units = spread.select(*names, F.explode(pairs).alias("part"), own.alias("own"), "vid", "mult", "v", "codes")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(n, *names, "part").sortWithinPartitions(*names, "part").mapInArrow(_link_buckets(threshold), LINKED)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    miss: float = MISS, seed: int = SEED, part_rows: int = PART_ROWS) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row.

    ``n_links`` counts the other rows whose vector has a cosine of at least
    ``threshold`` with this one's; ``component_id`` is the smallest id reachable
    by links.  A vector that is null, empty or zero, or holds null or
    non-finite components, links with nothing; vectors of different lengths do
    not link.  Equal rows stay rows of their own and link with one another.  A
    null id never names a component unless all its members' ids are null; then nothing
    of it is ``kept`` by name, so the result is null there.  Other columns are
    ignored.  A pair right at the threshold is missed with probability ``miss``.
    """
    base = with_row_key(rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")), ["id", "v"])
    good = F.col("good")
    base = base.withColumn("good", usable(F.col("v")))
    # -0.0 and 0.0 hash alike
    plain = F.transform("v", lambda x: x + F.lit(0.0))
    named = base.where(good).select(ROW_KEY, "id", "v", F.xxhash64(plain).alias("h1"), F.xxhash64(F.lit("v"), plain).alias("h2"))
    distinct = materialize(named.groupBy("h1", "h2").agg(
        F.min(ROW_KEY).alias("vid"), F.count("*").alias("mult"), F.min("id").alias("low"), F.min("v").alias("v")), "vectors")
    found = materialize(links(distinct, threshold, miss, seed, part_rows), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("vid")).agg(F.sum("n").alias("n"))
    groups = cut_lineage(connected_components(found.where("b is not null").select("a", "b")))
    known = distinct.select("h1", "h2", "vid", "mult", "low").join(counts, "vid", "left").join(
        groups.withColumnRenamed("node", "vid"), "vid", "left").withColumn("component", F.coalesce("component", "vid"))
    known = cut_lineage(known.select("h1", "h2", "low", "component", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links")))
    lowest = known.groupBy("component").agg(F.min("low").alias("component_id"))
    out = named.select("id", "h1", "h2").join(known.join(lowest, "component").select("h1", "h2", "n_links", "component_id"), ["h1", "h2"])
    alone = base.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.select("id", "n_links", "component_id").union(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
