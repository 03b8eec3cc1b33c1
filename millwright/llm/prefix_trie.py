"""Prefix trie of conversations, built from its leaves to the root by truncation peeling.

1. Each turn becomes a record of fixed length (digest of role and text, length
   of the text); a conversation is the string of its records, its path.
2. Paths are range-partitioned and sorted, so that the members of every node
   stand next to each other, whichever task they are in.
3. Each task peels its sorted stretches.  From the greatest depth down,
   conversations that end at a depth join the nodes that survived from below;
   all are cut by their last turn and regrouped by what is left.  A node's
   counts, leaves and savings are final when its level is grouped, so the trie
   is found and aggregated in one descent, on nodes instead of members.
4. A node whose members reach over the edge of a stretch is *open*: each
   stretch sends on its share of it.  A child is counted where it starts, a leaf
   where it ends, and the first copy of a text where it starts, so the shares of
   an open node, and of all its open ancestors, simply add up.  There are at
   most two paths of open nodes for a stretch, so a first turn that everybody
   shares is a sum of a few numbers from each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, materialize

#: Bytes of a turn in a path: 16 of digest, 4 of the text's length.
RECORD = 20
#: Conversations of a block share their first one's opening; a conversation's first ``crc32(id) % CUTS`` turns come from it.
BLOCK = 5
CUTS = 9
#: Ids in one piece of the list of an open node's ends.
CHUNK_IDS = 1_000
#: Open nodes up to which they are broadcast to their children; more are shuffled.
BROADCAST_ROWS = 1_000_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _record(role: Column, text: Column) -> Column:
    """A turn's record in hexadecimal."""
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(said.cast("binary")), F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): every conversation with the opening of its block's first one.

    Its first h turns are those of conversation ``conv_id - conv_id % 5`` (all
    if there are fewer, none if it is absent), with h the CRC-32 of the decimal
    id modulo 9; its own turns after the first h follow.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = F.col("conv_id").cast("long")
    turns = conversations.where("conv_id is not null").select(
        (own - own % BLOCK).alias("block"), own.alias("conv_id"), "turn", _record(role, text).alias("rec"))
    # one exchange: a conversation lies in its block
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("turn", "rec"))), lambda t: t["rec"])
    convs = turns.repartition("block").groupBy("block", "conv_id").agg(F.array_join(in_order, "").alias("own"))
    blocks = convs.groupBy("block").agg(F.collect_list(F.struct("conv_id", "own")).alias("convs"))
    first = F.filter("convs", lambda c: c["conv_id"] == F.col("block"))
    opening = F.when(F.size(first) > 0, F.get(first, F.lit(0))["own"]).otherwise("")
    one = blocks.select(opening.alias("opening"), F.explode("convs").alias("c")).select("opening", "c.*")
    cut = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % CUTS * (2 * RECORD)).cast("int")
    return one.select("conv_id", F.unhex(F.concat(
        F.substr("opening", F.lit(1), cut), F.substr("own", cut + 1))).alias("path"))


# -- peeling -----------------------------------------------------------------

def _shared(a: bytes, b: bytes) -> int:
    """Number of first turns that two paths share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // RECORD
    if a[:RECORD] != b[:RECORD]:
        return 0
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))) // RECORD


def _keys(path: bytes, depth: int) -> list[bytes]:
    """A digest of each of the path's openings of up to ``depth`` turns."""
    h, out = hashlib.md5(), []
    out.append(h.digest())
    for at in range(0, depth * RECORD, RECORD):
        h.update(path[at:at + RECORD])
        out.append(h.copy().digest())
    return out


NODE = pa.schema([
    ("kind", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.string())])
NODE_DDL = ("kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
            "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string")
CLOSED, OPEN, ENDS = 0, 1, 2


def peel(paths: list[bytes], ids: np.ndarray, before: int, after: int) -> Iterator[pa.RecordBatch]:
    """Rows (``NODE``) of all nodes of a sorted stretch; ``before`` and ``after`` are the turns that the rows just outside share with it (-1: none there)."""
    n = len(paths)
    lens = np.fromiter((len(p) // RECORD for p in paths), np.int64, n)
    shared = np.fromiter((0 if i == 0 else _shared(paths[i - 1], paths[i]) for i in range(n)), np.int64, n)
    shared[0] = -1  # a new node at every depth
    left_keys, right_keys = _keys(paths[0], max(before, 0)), _keys(paths[-1], max(after, 0))
    by_length = np.argsort(lens, kind="stable")
    bounds = np.searchsorted(lens[by_length], np.arange(lens.max() + 2))
    none = np.zeros(0, np.int64)
    level = {k: none for k in ("start", "end", "low", "leaves", "saved", "children", "mine")}
    level_open, level_key, level_sha = np.zeros(0, bool), [], []

    for depth in range(int(lens.max()), -2, -1):
        if depth >= 0:
            ended = by_length[bounds[depth]:bounds[depth + 1]]
            m = level["start"].size
            start, end = np.r_[level["start"], ended], np.r_[level["end"], ended + 1]
            by = np.argsort(start, kind="stable")
            start, end = start[by], end[by]
            survived = np.r_[np.ones(m, bool), np.zeros(ended.size, bool)][by]
            low = np.r_[level["low"], ids[ended]][by]
            zeros = np.zeros(ended.size, np.int64)
            leaves, saved = np.r_[level["leaves"], zeros][by], np.r_[level["saved"], zeros][by]
            at = np.flatnonzero((shared[start] < depth) | (start == 0))
            total = lambda x: np.add.reduceat(x, at)
            up = {"start": start[at], "end": end[np.r_[at[1:], start.size] - 1], "low": np.minimum.reduceat(low, at)}
            left, right = (up["start"] == 0) & (depth <= before), (up["end"] == n) & (depth <= after)
            kids = total(survived.astype(np.int64))
            # a child that began in an earlier stretch was counted there
            up["children"] = total((survived & ~((start == 0) & (depth + 1 <= before))).astype(np.int64))
            size = np.fromiter((int.from_bytes(paths[i][depth * RECORD - 4:depth * RECORD], "big") if depth else 0
                                for i in up["start"].tolist()), np.int64, at.size)
            up["saved"] = total(saved) + (up["end"] - up["start"]) * size - np.where(left, 0, size)
            up["leaves"] = total(leaves) + ((kids == 0) & ~right)
            up["mine"] = total((~survived).astype(np.int64))
            up_open = left | right
            up_key = [left_keys[depth] if left[i] else right_keys[depth] if right[i] else None for i in range(at.size)]
            up_sha, taken = [], 0
            for count, is_open, key in zip(up["mine"].tolist(), up_open.tolist(), up_key):
                own = ids[ended[taken:taken + count]]  # sorted, as rows are
                taken += count
                up_sha.append(None if is_open else hashlib.sha256(",".join(map(str, own.tolist())).encode()).hexdigest()
                              if count else EMPTY_SHA256)
                if is_open and count:
                    pieces = [own[k:k + CHUNK_IDS] for k in range(0, count, CHUNK_IDS)]
                    yield pa.RecordBatch.from_pylist(
                        [{"kind": ENDS, "key": key, "conv_id": int(p[0]), "ends": ",".join(map(str, p.tolist()))} for p in pieces], NODE)
            parent = np.searchsorted(at, np.flatnonzero(survived), side="right") - 1
        else:
            parent = np.full(level["start"].size, -1)
        # the nodes of the level below, now that their parents are known
        if level["start"].size:
            rooted = depth < 0
            p_open = np.zeros(parent.size, bool) if rooted else up_open[parent]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.where(level_open, OPEN, CLOSED).astype(np.int32)), pa.array(level_key, pa.binary()),
                pa.array([up_key[i] if o else None for i, o in zip(parent.tolist(), p_open.tolist())], pa.binary()),
                pa.array(level["low"]), pa.array(np.full(parent.size, depth + 1, np.int64)),
                pa.array([None] * parent.size if rooted else up["low"][parent], pa.int64(), mask=p_open if not rooted else None),
                pa.array(level["end"] - level["start"]), pa.array(level["children"]), pa.array(level["leaves"]),
                pa.array(level["saved"]), pa.array(level_sha, pa.string()), pa.nulls(parent.size, pa.string())], schema=NODE)
        if depth >= 0:
            level, level_open, level_key, level_sha = up, up_open, up_key, up_sha


def _peel_parts(edges: dict[int, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, last = None, -1, None

        def stretch(b: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, int]:
            return b.column(0).to_pylist(), b.column(1).to_numpy(), int(b.column(2)[0].as_py())

        for b in batches:
            if not b.num_rows:
                continue
            paths, ids, part = stretch(b)
            if held is None:
                before = edges[part][0]
            else:
                after = _shared(held[0][-1], paths[0])
                yield from peel(held[0], held[1], before, after)
                before = after
            held, last = (paths, ids), part
        if held is not None:
            yield from peel(held[0], held[1], before, edges[last][1])
    return run


def _edges(ordered: DataFrame) -> dict[int, tuple[int, int]]:
    """For each part of the sorted table, the turns that it shares with the row before it and the row after it (-1: no row)."""
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = part = None
        for b in batches:
            if b.num_rows:
                if first is None:
                    first, part = b.column(0)[0], b.column(1)[0]
                last = b.column(0)[b.num_rows - 1]
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x.as_py()], t) for x, t in ((part, pa.int32()), (first, pa.binary()), (last, pa.binary()))],
                                             ["part", "first", "last"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, first, prior = (c.to_pylist() for c in b.columns)
            got = [-1 if p is None else _shared(p, f) for f, p in zip(first, prior)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(got, pa.int32())], ["part", "before"])

    # a row for each part, so the window is as small as the number of tasks
    by_part = Window.orderBy("part")
    sides = ordered.select("path", "part").mapInArrow(ends, "part int, first binary, last binary")
    met = sides.select("part", "first", F.lag("last").over(by_part).alias("prior")).mapInArrow(meet, "part int, before int")
    rows = met.orderBy("part").collect()  # two numbers for each task
    after = [r.before for r in rows[1:]] + [-1]
    return {r.part: (r.before, a) for r, a in zip(rows, after)}


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of id lists -> (key, SHA-256 of the whole list), one piece in memory at a time."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    for b in batches:
        for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    yield row()
                key, digest = k, hashlib.sha256()
                digest.update(text.encode())
            else:
                digest.update(b"," + text.encode())
    if key is not None:
        yield row()


def trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of ``paths`` (conv_id, path): one row per node, see ``conversation_trie``."""
    spark = paths.sparkSession
    ordered = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    ordered = cut_lineage(ordered.select("path", "conv_id", F.spark_partition_id().alias("part")))
    found = materialize(ordered.mapInArrow(_peel_parts(_edges(ordered)), NODE_DDL), "trie")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    shares = found.where(F.col("kind") == OPEN).groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums)
    lists = found.where(F.col("kind") == ENDS).repartition("key").sortWithinPartitions("key", "conv_id").select(
        "key", "ends").mapInArrow(_hashed_ends, "key binary, ends_sha256 string")
    whole = cut_lineage(shares.join(lists, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))))
    small = F.broadcast if whole.count() <= BROADCAST_ROWS else lambda df: df
    above = small(whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    closed = found.where(F.col("kind") == CLOSED)
    under_open = closed.where("parent_key is not null").drop("parent_conv_id").join(above, "parent_key")
    return closed.where("parent_key is null").select(*columns).union(under_open.select(*columns)).union(
        whole.join(above, "parent_key", "left").select(*columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) for each node of the rebuilt conversations' trie.

    A node is a distinct opening of ``depth`` turns, named by its smallest
    member.  Turns are ordered by ``turn``, null first; equal turn numbers by
    the digest of role and text, so repeated rows are turns of their own.  Null
    roles and texts are empty.  Rows without a conversation id belong to no
    conversation.  Other columns are ignored.  An empty table has no nodes.
    The turns of one conversation (20 bytes each) fit in a task.
    """
    return trie(rebuilt_paths(conversations))
