"""SentencePiece encoding and decoding with sampled segmentations.

The lattice of a text has a node for each place between characters and an
edge for each vocabulary piece that spells out the text between two nodes.
It falls apart into units (a run of letters, digits, marks or white space with the
spaces before it), which no piece crosses.  Pieces are weighted by Zipf's law
on their rank in the model (its scores are ranks, not probabilities), so a
segmentation's probability is the normalised product of its pieces'.

Segmentations are drawn without replacement by perturbed A* search (Gumbel
top-k): a search node is a prefix together with the alternatives not yet taken
after it; its mass is known exactly from a backward pass over the lattice, and
its priority is a Gumbel variable of that mass, bounded by the priority of the
node that it was split from.  The node with the highest priority is taken
from the queue, one segmentation is drawn from it, and the alternatives along
that segmentation go back to the queue.  The k segmentations are distinct, and
the priority left at the head of the queue gives each one's inclusion score.

All random numbers come from the row's key and the place where they are used,
so a row gives the same result in any task, batch or order.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 3
SEED = 17
#: Texts are taken together up to so many characters.
_SLICE_CHARS = 400_000
#: Lattice nodes that are kept for units that come again.
_CACHE_NODES = 1_500_000
#: Those of them that stay when the others are dropped.
_KEPT_NODES = 600_000
#: Marks, underscores, carriage returns and ² are one class: the model has pieces of them together.
_UNIT = re.compile(r" *(?:[^\W\d_²]+|\d+|(?:[^\w\s]|[_\r²])+)| +|[^\S \r]+|.", re.DOTALL)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as text and as the bytes that they decode to, and their log weights; bounded by the model's size."""

    spelled: dict[str, int]
    decoded: list[bytes]
    weight: list[float]
    byte_ids: list[int]


def load_vocabulary(path: str = MODEL_PATH) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    spelled, decoded, byte_ids = {}, [b""] * n, [0] * 256
    ranks = [0.0] * n
    for i in range(n):
        if sp.is_control(i) or sp.is_unknown(i):
            continue
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            decoded[i] = bytes([int(piece[3:5], 16)])
            ranks[i] = n
        else:
            text = piece.replace("▁", " ")
            spelled[text], decoded[i] = i, text.encode()
            ranks[i] = 1 - sp.get_score(i)
    total = math.log(sum(1 / r for r in ranks if r))
    return Vocabulary(spelled, decoded, [-math.log(r) - total if r else 0.0 for r in ranks], byte_ids)


def units(text: str) -> list[str]:
    """The text behind a leading space, cut into units."""
    return _UNIT.findall(" " + text)


_HASH = np.uint64(0x9E3779B97F4A7C15)


def _extended(prefix: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hash of strings made one character longer."""
    h = (prefix + codes.astype(np.uint64) + np.uint64(1)) * _HASH
    return h ^ (h >> np.uint64(29))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


class Lattices:
    """Lattices of units, side by side in flat arrays; every edge is one piece.

    Edges hold the probability of the piece given that the path has come to its node,
    which the backward pass yields.  New units are built together: pieces are found for all
    places at once, one character longer at a time, by hashes of the vocabulary's prefixes.
    """

    _GROW = ("piece", "after", "cumulative", "log_p", "log_rest")

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.weight = np.array(vocabulary.weight)
        self.byte_ids = np.array(vocabulary.byte_ids, np.int32)
        # for each length, the sorted hashes of all prefixes of pieces, and the piece that is one
        names = list(vocabulary.spelled)
        ids = np.array([vocabulary.spelled[n] for n in names], np.int32)
        sizes = np.array([len(n) for n in names])
        h = np.zeros(len(names), np.uint64)
        self.prefixes: list[tuple[np.ndarray, np.ndarray]] = []
        for n in range(1, int(sizes.max(initial=0)) + 1):
            on = sizes >= n
            h[on] = _extended(h[on], np.array([ord(names[i][n - 1]) for i in np.flatnonzero(on)], np.uint32))
            known = np.unique(h[on])
            piece = np.full(known.size, -1, np.int32)
            whole = sizes == n
            piece[np.searchsorted(known, h[whole])] = ids[whole]
            self.prefixes.append((known, piece))
        self.clear()

    def keep(self, nodes: int) -> None:
        """Units known by the time that there are so many nodes are kept: the frequent ones are among them."""
        if self.kept is None and self.nodes >= nodes:
            self.kept = dict(self.start), self.nodes, self.edges

    def forget(self) -> None:
        """Drops all units but those that are kept."""
        start, self.nodes, self.edges = self.kept or ({}, 0, 0)
        self.start = dict(start)

    def clear(self) -> None:
        self.kept: tuple[dict[str, int], int, int] | None = None
        self.start: dict[str, int] = {}
        self.nodes = self.edges = 0
        self.first = np.zeros(1024, np.int32)
        self.degree = np.zeros(1024, np.int32)
        self.piece = np.zeros(1024, np.int32)
        self.after = np.zeros(1024, np.int32)
        self.cumulative = np.zeros(1024)
        self.log_p = np.zeros(1024)
        self.log_rest = np.zeros(1024)

    def _append(self, name: str, at: int, values: np.ndarray) -> None:
        have = getattr(self, name)
        if at + values.size > have.size:
            have = np.concatenate([have[:at], np.zeros(max(at, values.size), have.dtype)])
            setattr(self, name, have)
        have[at:at + values.size] = values

    def starts(self, text_units: list[str]) -> list[int]:
        """First node of each unit's lattice; units not seen before are added."""
        known = self.start
        new = [u for u in dict.fromkeys(text_units) if u not in known]
        if new:
            self._add(new)
        return list(map(known.__getitem__, text_units))

    def _found(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, piece) of every piece that stands somewhere; ``left``: characters to the unit's end."""
        at = np.arange(codes.size)
        h = np.zeros(codes.size, np.uint64)
        out = []
        for n, (known, piece) in enumerate(self.prefixes, 1):
            fits = left[at] >= n
            at, h = at[fits], h[fits]
            if not at.size:
                break
            h = _extended(h, codes[at + n - 1])
            k = np.minimum(np.searchsorted(known, h), known.size - 1)
            there = known[k] == h
            at, h, k = at[there], h[there], k[there]
            whole = piece[k] >= 0
            out.append((at[whole], np.full(int(whole.sum()), n), piece[k[whole]]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3

    def _add(self, new: list[str]) -> None:
        sizes = np.array([len(u) for u in new])
        ends = np.cumsum(sizes)
        codes = _codes("".join(new))
        total = int(ends[-1])
        end = np.repeat(ends, sizes)
        left = end - np.arange(total)
        src, length, piece = self._found(codes, left)
        dst = src + length
        # characters without a piece are spelled out in bytes, through nodes of their own
        alone = np.ones(total, bool)
        alone[src[length == 1]] = False
        b_src, b_dst, b_piece, b_last, nodes = [], [], [], [], total
        for i in np.flatnonzero(alone).tolist():
            raw = chr(codes[i]).encode("utf-8", "replace")
            here = i
            for k, byte in enumerate(raw):
                to = i + 1 if k + 1 == len(raw) else nodes
                b_src.append(here)
                b_dst.append(to)
                b_piece.append(byte)
                b_last.append(k + 1 == len(raw) and i + 1 == end[i])
                here = to
                nodes += k + 1 < len(raw)
        # the end of one unit is the place where the next begins: edges to it end there
        last = np.concatenate([dst == end[src], np.array(b_last, bool)])
        src = np.concatenate([src, np.array(b_src, np.int64)])
        dst = np.concatenate([dst, np.array(b_dst, np.int64)])
        piece = np.concatenate([piece, self.byte_ids[np.array(b_piece, np.int64)]])
        order = np.lexsort((-dst, src))  # by node, longer pieces first
        src, dst, piece, last = src[order], dst[order], piece[order].astype(np.int32), last[order]
        first = np.searchsorted(src, np.arange(nodes))
        degree = np.diff(np.r_[first, src.size])
        # backward pass, by distance from the unit's end; inside a character by what is left of it too
        depth = np.zeros(nodes)
        depth[:total] = left
        for s_, d_ in zip(reversed(b_src), reversed(b_dst)):
            if s_ >= total:
                depth[s_] = (depth[d_] if d_ >= total else left[d_ - 1] - 1) + 1 / 8
        beta = np.zeros(nodes + 1)
        reach = np.where(last, nodes, dst)  # beta of the end is 0
        score = self.weight[piece]
        by = np.argsort(depth, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(depth[by]) > 0, True]) if nodes else np.zeros(1, int)
        for i, j in zip(cuts[:-1], cuts[1:]):
            ns = by[i:j]
            ns = np.sort(ns)
            d = degree[ns]
            begin = np.cumsum(d) - d
            es = np.repeat(first[ns] - begin, d) + np.arange(int(d.sum()))
            score[es] += beta[reach[es]]
            beta[ns] = np.logaddexp.reduceat(score[es], begin)
        log_p = np.minimum(0.0, score - beta[src])
        p = np.exp(log_p)
        single = degree[src] == 1
        log_p[single] = 0.0
        with np.errstate(divide="ignore"):
            log_rest = np.where(single | (p >= 1), -np.inf, np.log1p(-np.minimum(p, 1)))
        cumulative = p.copy()
        at = first
        for k in range(1, int(degree.max(initial=0))):  # by rank: rounding doesn't depend on other units
            at = at[degree[src[at]] > k] + 1
            cumulative[at] += cumulative[at - 1]
        cumulative[first + degree - 1] = 2.0  # the last edge takes what rounding leaves
        for name, values in (("piece", piece), ("after", np.where(last, -1, dst + self.nodes).astype(np.int32)),
                             ("cumulative", cumulative), ("log_p", log_p), ("log_rest", log_rest)):
            self._append(name, self.edges, values)
        self._append("first", self.nodes, (first + self.edges).astype(np.int32))
        self._append("degree", self.nodes, degree.astype(np.int32))
        self.start.update(zip(new, (ends - sizes + self.nodes).tolist()))
        self.nodes += nodes
        self.edges += src.size

    def arrays(self) -> dict[str, np.ndarray]:
        """The arrays as they are now; units added later may move them."""
        return {c: getattr(self, c) for c in ("first", "degree", *self._GROW)}


# -- random numbers by place -------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed(key: np.ndarray, *place) -> np.ndarray:
    """A 64-bit key mixed with whole numbers that name a place; further ones can be mixed in later."""
    x = key
    with np.errstate(over="ignore"):
        for p in place:
            x = _mix(x + np.asarray(p).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    return x


def uniform(key: np.ndarray, *place) -> np.ndarray:
    """Numbers in (0, 1) that depend on a 64-bit key and whole numbers that name the place."""
    return ((mixed(key, *place) >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52


# -- the search --------------------------------------------------------------

@dataclass
class _Path:
    """One segmentation of each text: its edges, and the priority of the alternatives at each."""

    edge: np.ndarray      # by text, unit and step
    node: np.ndarray
    unit: np.ndarray      # of each edge
    step: np.ndarray      # of each edge in its unit
    text: np.ndarray      # of each edge
    begin: np.ndarray     # first edge of each text, and the end
    prefix: np.ndarray    # log probability of what comes before each edge
    left: np.ndarray      # priority of the alternatives at each edge, minus infinity if they are another path's
    priority: np.ndarray  # of each text's segmentation
    log_prob: np.ndarray
    alive: np.ndarray     # texts that have this segmentation
    parent: np.ndarray    # path that it branched from, for each text
    branch: np.ndarray    # edge, counted within the text, at which it branched


class Sampler:
    """Draws ``k`` distinct segmentations for each text of a slice, all texts side by side."""

    def __init__(self, lattices: Lattices, k: int) -> None:
        self.lattices, self.k = lattices, k

    def __call__(self, texts: list[str], keys: np.ndarray) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For each text, (ids, log probability, priority, log inclusion score) by falling priority."""
        cut = [units(t) if t else [] for t in texts]
        start = np.array(self.lattices.starts([x for u in cut for x in u]), np.int64)
        self.of = np.repeat(np.arange(len(texts)), [len(u) for u in cut])
        self.n = len(texts)
        self.unit_first = np.searchsorted(self.of, np.arange(self.n + 1))
        self.a = self.lattices.arrays()
        self.keys, self.start = keys, start
        none = np.zeros(self.n, np.int64)
        gumbel = -np.log(-np.log(uniform(keys, 0, 0)))
        paths = [self._follow(0, np.arange(start.size), start, np.zeros(start.size, np.int64), none[:0], none[:0],
                              np.zeros(0, np.int64), np.zeros(0, np.int64), gumbel, np.ones(self.n, bool), none - 1, none)]
        head = self._head(paths)
        for r in range(1, self.k):
            paths.append(self._branch(r, paths, head))
            head = self._head(paths)
        kappa = head[0]
        out: list[list] = [[] for _ in texts]
        for path in paths:
            ids = self.a["piece"][path.edge]
            edges = path.begin
            with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
                score = np.log(-np.expm1(-np.exp(path.log_prob - kappa)))
            score = np.where(path.log_prob - kappa < -30, path.log_prob - kappa, score)
            for t in np.flatnonzero(path.alive).tolist():
                out[t].append((ids[edges[t]:edges[t + 1]], float(path.log_prob[t]), float(path.priority[t]), float(score[t])))
        self.a = {}
        return out

    def _draw(self, unit: np.ndarray, node: np.ndarray, step: np.ndarray, r: int):
        """Follows random edges from a node of each unit to the unit's end: (unit, step, node, edge) of each."""
        a, found = self.a, []
        place = unit - self.unit_first[self.of[unit]]
        key = mixed(self.keys, r + 1)[self.of[unit]]
        key = mixed(key, place)  # the same for all steps of a unit
        while unit.size:
            u = uniform(key, step)
            edge = a["first"][node].astype(np.int64)
            low = np.flatnonzero(u > a["cumulative"][edge])
            while low.size:
                edge[low] += 1
                low = low[u[low] > a["cumulative"][edge[low]]]
            found.append((unit, step, node, edge))
            after = a["after"][edge]
            on = np.flatnonzero(after >= 0)
            unit, step, node, key = unit[on], step[on] + 1, after[on].astype(np.int64), key[on]
        return [np.concatenate(x) if found else np.zeros(0, np.int64) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4

    def _follow(self, r, unit, node, step, old_unit, old_step, old_node, old_edge, priority, alive, parent, branch) -> _Path:
        """The path of given edges and those drawn from where they end."""
        got = self._draw(unit, node, step, r)
        unit, step, node, edge = (np.concatenate([x, y]) for x, y in zip((old_unit, old_step, old_node, old_edge), got))
        count = np.bincount(unit, minlength=self.of.size)
        first = np.cumsum(count) - count
        at = first[unit] + step
        edges, nodes = np.empty(at.size, np.int64), np.empty(at.size, np.int64)
        edges[at], nodes[at] = edge, node
        unit = np.repeat(np.arange(count.size), count)
        step = np.arange(unit.size) - first[unit]
        text = self.of[unit]
        lp = self.a["log_p"][edges]
        begin = np.searchsorted(text, np.arange(self.n + 1))
        prefix = np.empty(lp.size)
        for i, j in zip(begin[:-1].tolist(), begin[1:].tolist()):  # by text: rounding doesn't depend on neighbours
            np.cumsum(lp[i:j], out=prefix[i:j])
        prefix -= lp
        log_prob = np.bincount(text, lp, self.n)
        mass = prefix + self.a["log_rest"][edges]
        place = np.arange(text.size) - begin[text]
        with np.errstate(divide="ignore"):
            left = self._below(mass, priority[text], uniform(self.keys[text], r + 1, place, 1 << 40))
        left[place < branch[text]] = -np.inf
        return _Path(edges, nodes, unit, step, text, begin, prefix, left, priority, log_prob, alive, parent, branch)

    @staticmethod
    def _below(mass, bound, u):
        """A Gumbel variable at ``mass`` given that it is below ``bound``."""
        return np.where(mass == -np.inf, -np.inf, mass - np.log(np.exp(np.minimum(mass - bound, 700)) - np.log(u)))

    def _head(self, paths: list[_Path]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text the highest priority in its queue, its path, and the edge within the text."""
        best, of, at = np.full(self.n, -np.inf), np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for r, p in enumerate(paths):
            if not p.left.size:
                continue
            begin = p.begin
            top = np.full(self.n, -np.inf)
            real = np.flatnonzero(begin[:-1] < begin[1:])
            top[real] = np.maximum.reduceat(p.left, begin[:-1][real])
            top[~p.alive] = -np.inf
            hit = np.flatnonzero(p.left == top[p.text])
            where = np.zeros(self.n, np.int64)
            where[p.text[hit[::-1]]] = hit[::-1]  # the first one stays
            better = top > best
            best[better], of[better], at[better] = top[better], r, (where - begin[:-1])[better]
        return best, of, at

    def _branch(self, r: int, paths: list[_Path], head) -> _Path:
        """Takes each text's best search node and draws a segmentation from it."""
        best, of, at = head
        alive = best > -np.inf
        a = self.a
        branch_unit = np.full(self.n, -1, np.int64)
        some = np.flatnonzero(alive)
        chosen = np.zeros((some.size, 4), np.int64)  # unit, step, node, edge
        after = np.full(some.size, -1, np.int64)
        rest = np.full(self.n, -np.inf)
        draws = uniform(self.keys[some], r + 1, 1 << 41).tolist()
        for i, t in enumerate(some.tolist()):
            q, place = int(of[t]), int(at[t])
            p = paths[q]
            where = int(p.begin[t]) + place
            here = int(p.node[where])
            # edges that earlier segmentations took from this node
            taken = {int(p.edge[where])}
            p.left[where] = -np.inf  # what is left of it goes with the new path
            while paths[q].parent[t] >= 0 and paths[q].branch[t] == place:
                q = int(paths[q].parent[t])
                taken.add(int(paths[q].edge[int(paths[q].begin[t]) + place]))
            first = int(a["first"][here])
            lps = a["log_p"][first:first + int(a["degree"][here])].tolist()
            free = [(first + k, lp) for k, lp in enumerate(lps) if first + k not in taken]
            top = max(lp for _, lp in free)
            weights = [math.exp(lp - top) for _, lp in free]
            u, k = draws[i] * sum(weights), 0
            while k + 1 < len(free) and u > weights[k]:
                u -= weights[k]
                k += 1
            others = sum(w for j, w in enumerate(weights) if j != k)
            if others > 0:
                rest[t] = p.prefix[where] + top + math.log(others)
            branch_unit[t] = p.unit[where]
            chosen[i] = p.unit[where], p.step[where], here, free[k][0]
            after[i] = a["after"][free[k][0]]
        # what stays of the path branched from: its edges before the branch
        old = [[chosen[:, c]] for c in range(4)]
        for q, p in enumerate(paths):
            mine = alive & (of == q)
            keep = np.flatnonzero(mine[p.text] & (np.arange(p.text.size) - p.begin[p.text] < at[p.text]))
            for have, more in zip(old, (p.unit, p.step, p.node, p.edge)):
                have.append(more[keep])
        # what is drawn: the rest of the branch's unit, and all units after it
        on = after >= 0
        later = np.flatnonzero(alive[self.of] & (np.arange(self.of.size) > branch_unit[self.of]))
        unit = np.concatenate([chosen[on, 0], later])
        node = np.concatenate([after[on], self.start[later]])
        step = np.concatenate([chosen[on, 1] + 1, np.zeros(later.size, np.int64)])
        path = self._follow(r, unit, node, step, *[np.concatenate(x) for x in old], np.where(alive, best, -np.inf), alive,
                            np.where(alive, of, -1), np.where(alive, at, 0))
        u = uniform(self.keys[some], r + 1, 1 << 42)
        path.left[path.begin[some] + at[some]] = self._below(rest[some], best[some], u)
        return path


def decode(vocabulary: Vocabulary, ids) -> str:
    """Text of a sequence of ids; the exact inverse of any segmentation of a text."""
    return b"".join(map(vocabulary.decoded.__getitem__, ids)).decode("utf-8", "replace")[1:]


class Decoder:
    """Decodes many sequences of ids at a time, from the pieces' bytes side by side."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.bytes = np.frombuffer(b"".join(vocabulary.decoded), np.uint8)
        self.size = np.array([len(d) for d in vocabulary.decoded], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def __call__(self, sequences: list[np.ndarray]) -> list[str]:
        ids = np.concatenate([np.zeros(0, np.int32), *sequences])
        size = self.size[ids]
        to = np.cumsum(size)
        at = np.repeat(self.start[ids] - to + size, size) + np.arange(int(to[-1]) if to.size else 0)
        text = self.bytes[at].tobytes()
        ends = np.r_[0, to][np.cumsum([0] + [s.size for s in sequences])].tolist()
        return [text[i:j].decode("utf-8", "replace")[1:] for i, j in zip(ends, ends[1:])]


def sample_segmentations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES,
                         model_path: str = MODEL_PATH, seed: int = SEED) -> DataFrame:
    """(id_col, rank, ids, log_prob, perturbed, log_inclusion, decoded): distinct segmentations of each text.

    A row for each of the first ``samples`` segmentations by falling perturbed
    log probability, fewer if the lattice has fewer.  ``log_inclusion`` is the
    log of the probability that the segmentation is above the next one's
    priority (0 if there is no next).  An empty text has the empty segmentation; a null text
    has rank 0, null ids and null scores.  The seed of a row is its id; rows with
    equal or null ids and equal texts get equal samples.  Other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(load_vocabulary(model_path))  # one tokenizer's pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        lattices, decoder = _kept(vocabulary), Decoder(vocabulary)
        for b in batches:
            keys = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            texts = b.column(2).to_pylist()
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end] or "") <= _SLICE_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                found = Sampler(lattices, samples)([t or "" for t in texts[at:end]], keys[at:end])
                rows = [(i, k, *s) for i, f in enumerate(found) if texts[at + i] is not None for k, s in enumerate(f, 1)]
                rows += [(i, 0, None, None, None, None) for i in range(end - at) if texts[at + i] is None]
                ids = [r[2] for r in rows]
                back = iter(decoder([x for x in ids if x is not None]))
                texts_back = [None if x is None else next(back) for x in ids]
                sizes = np.array([0 if x is None else x.size for x in ids], np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32), mask=np.r_[[x is None for x in ids], False].astype(bool)),
                    pa.array(np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)]), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([at + r[0] for r in rows], pa.int32())), pa.array([r[1] for r in rows], pa.int32()),
                     lists, *[pa.array([r[c] for r in rows], pa.float64()) for c in (3, 4, 5)],
                     pa.array(texts_back, pa.string())],
                    ["id", "rank", "ids", "log_prob", "perturbed", "log_inclusion", "decoded"])
                at = end
                lattices.keep(_KEPT_NODES)
                if lattices.nodes > _CACHE_NODES:
                    lattices.forget()

    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("key"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, rank int, ids array<int>, log_prob double, perturbed double, log_inclusion double, "
             "decoded string").withColumnRenamed("id", id_col)


_LATTICES: dict[int, Lattices] = {}


def _kept(vocabulary: Vocabulary) -> Lattices:
    """Lattices that outlive a task in the same Python worker; one vocabulary at a time."""
    size = hash((len(vocabulary.decoded), tuple(vocabulary.weight[:300]), tuple(vocabulary.decoded[:1000])))
    if size not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[size] = Lattices(vocabulary)
    return _LATTICES[size]
