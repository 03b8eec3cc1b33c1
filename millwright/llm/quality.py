"""Quality classifier by co-training.

Two views of a document each get a classifier of their own: what its text is
like (which words it has, and its make-up), and what is known about the page
(source, language tag, size).  Over a few rounds each view labels unlabelled
documents that it is sure about, and the other view learns from them.  Each
view is calibrated on labelled documents kept aside, and the calibrated views
are combined into one score for every document.

The classifiers are fitted on a bounded sample of labelled documents
(``max_labelled``).  Both views score all unlabelled documents in every round, from
a stored table of compact features, and only the surest of them come to the fit:
at most as many of a class as the sample has.
"""

from __future__ import annotations

import logging
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Labelled documents that the classifiers are fitted on, at most.
MAX_LABELLED = 10_000
#: Labelled ids up to which they are broadcast to pick the unlabelled documents; more are shuffled.
BROADCAST_ROWS = 1_000_000
ROUNDS = 3
#: Calibrated probability from which a view is sure of a pseudo-label.
SURE = 0.98
#: Documents that score below this are rejected.
THRESHOLD = 0.5
_SLOTS = 1 << 20
_META_SLOTS = 64
#: Words that the text view keeps, and how far their use has to differ between the classes (chi-square).
_MAX_WORDS = 400
#: Words of labelled documents that differ most between the classes; in every round the text view chooses among them.
_CANDIDATES = 2048
_MIN_CHI2 = 12.0
_WORD = re.compile(r"[^\W_]+")
_MAKE_UP = 12
_CALIBRATION_SHARE = 4  # one in so many labelled documents


def _slot(word: str, slots: int = _SLOTS) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % slots


class _Slots(dict):
    """Slots of words seen before; bounded."""

    def __missing__(self, word: str) -> int:
        s = _slot(word)
        if len(self) < 300_000:
            self[word] = s
        return s


_KNOWN_SLOTS = _Slots()
#: Beginnings of words are features too, so that other forms of a word are known by its stem.
_STEMS = (3, 4, 5)


_BYTE_KIND = np.zeros(256, np.int64)
for _kind, _chars in enumerate((b" \t\r", b"\n", bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b".,;:'\"()-?"), 1):
    _BYTE_KIND[list(_chars)] = _kind
_BYTE_KIND[33:127][_BYTE_KIND[33:127] == 0] = 7  # other marks


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots of the distinct words and stems, make-up of the text), from the whole text."""
    raw = (text or "").encode("utf-8", "replace")
    counts = np.bincount(_BYTE_KIND, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), 8)
    words = _WORD.findall((text or "").lower())
    distinct = set(words)
    letters = max(1.0, counts[2] + counts[3])
    total = max(1, len(raw))
    length = sum(map(len, words))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    make_up = np.array([
        counts[2] / letters, counts[4] / total, counts[5] / total, counts[7] / total, counts[1] / total * 20,
        (counts[1] + counts[6]) / total, len(distinct) / max(1, len(words)), repeats / max(1, len(words)),
        length / max(1, len(words)) / 10, min(1.0, counts[7] / max(1, len(words))), float(not words),
        len(distinct) / max(1.0, len(words) ** 0.7)])
    named = distinct.union(*({w[:n] + "*" for w in distinct if len(w) > n} for n in _STEMS))
    return np.unique(np.fromiter(map(_KNOWN_SLOTS.__getitem__, named), np.int32, len(named))), make_up


def _meta_code(source: str | None, lang: str | None, n_chars: int | None) -> list[int]:
    """Slots of source and language, and the size; -1 if it isn't known."""
    return [_slot(f"source {source}", _META_SLOTS), _slot(f"lang {lang}", _META_SLOTS), -1 if n_chars is None else max(0, n_chars)]


def _meta_matrix(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), _META_SLOTS + 3))
    at = np.arange(len(codes))
    out[at, codes[:, 0]] += 1
    out[at, codes[:, 1]] += 1
    size = np.log1p(np.maximum(0, codes[:, 2])) / 10
    out[:, -3], out[:, -2], out[:, -1] = size, size * size, codes[:, 2] < 0
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    return _meta_matrix(np.array([_meta_code(source, lang, n_chars)]))[0]


# -- two small classifiers ---------------------------------------------------

def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept.

    Sums over rows are taken in slices, so besides ``x`` only tables of the size of the weights are held.
    """
    n = x.shape[1] + 1
    penalty = np.r_[np.full(n - 1, ridge), 1e-6]
    w = np.zeros(n)
    for _ in range(steps):
        curvature, slope = np.diag(penalty), penalty * w
        for i in range(0, len(x), 1000):
            part = np.c_[x[i:i + 1000].astype(np.float64), np.ones(len(x[i:i + 1000]))]
            p = _sigmoid(part @ w)
            curvature = curvature + (part * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ part
            slope = slope + part.T @ (p - y[i:i + 1000])
        step = np.linalg.solve(curvature, slope)
        step *= min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class TextView:
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(_MAKE_UP))
    scale: np.ndarray = field(default_factory=lambda: np.ones(_MAKE_UP))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(_MAKE_UP + 1))

    def _matrix(self, rows) -> np.ndarray:
        x = np.zeros((len(rows), self.words.size + _MAKE_UP), np.float32)
        for i, (slots, make_up) in enumerate(rows):
            x[i, np.flatnonzero(np.isin(self.words, slots, assume_unique=True))] = 1
            x[i, self.words.size:] = np.clip((make_up - self.mean) / self.scale, -4, 4)
        return x

    def fit(self, rows, y: np.ndarray) -> TextView:
        seen, good = np.zeros(_SLOTS), np.zeros(_SLOTS)
        for i in range(0, len(rows), 500):  # counted in slices: the driver holds one table of slots
            for total, part in ((seen, rows[i:i + 500]), (good, [r for r, v in zip(rows[i:i + 500], y[i:i + 500]) if v > 0])):
                if part:
                    total += np.bincount(np.concatenate([s for s, _ in part]), minlength=_SLOTS)
        slots = np.flatnonzero(seen)
        seen, good = seen[slots], good[slots]
        n, n1 = len(y), float(y.sum())
        a, b = good, seen - good
        c, d = n1 - a, (n - n1) - b
        with np.errstate(divide="ignore", invalid="ignore"):
            chi2 = np.nan_to_num(n * np.maximum(0, np.abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d)))
        best = np.argsort(-chi2, kind="stable")[:_MAX_WORDS]
        self.words = np.sort(slots[best[chi2[best] >= _MIN_CHI2]]).astype(np.int32)
        make_up = np.array([m for _, m in rows])
        self.mean, self.scale = make_up.mean(0), make_up.std(0) + 1e-6
        self.weights = _logistic(self._matrix(rows), y, ridge=1.0)
        return self

    def logit(self, rows) -> np.ndarray:
        return self._matrix(rows) @ self.weights[:-1] + self.weights[-1]


@dataclass
class MetaView:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(_META_SLOTS + 4))

    def fit(self, x: np.ndarray, y: np.ndarray) -> MetaView:
        self.weights = _logistic(x, y, ridge=5.0)
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:-1] + self.weights[-1]


@dataclass
class Model:
    text: TextView
    meta: MetaView
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    mix: np.ndarray  # weights of the calibrated logits, and the intercept

    def scores(self, rows, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = self.text_scale[0] * self.text.logit(rows) + self.text_scale[1]
        m = self.meta_scale[0] * self.meta.logit(x) + self.meta_scale[1]
        return _sigmoid(t), _sigmoid(m), _sigmoid(self.mix[0] * t + self.mix[1] * m + self.mix[2])


def _calibrate(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling; a view that ranks the wrong way round is not turned round but muted."""
    w = _logistic(logit[:, None] / 5, y, ridge=0.05)
    if w[0] <= 0:
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        return 0.0, float(np.log(p / (1 - p)))
    return float(w[0] / 5), float(w[1])


def co_train(labelled, y: np.ndarray, aside: np.ndarray, pool, rounds: int = ROUNDS, sure: float = SURE) -> Model | None:
    """Fits both views; rows are (word slots, make-up, metadata), ``aside`` marks those kept for calibration.

    ``pool`` has the unlabelled rows: a list, or a ``Pool``.  None if a class is missing on either side of the split.
    """
    if any(len(set(y[part].tolist())) < 2 for part in (aside, ~aside)):
        return None
    words = [r[:2] for r in labelled]
    meta = np.array([r[2] for r in labelled])
    use, kept = np.flatnonzero(~aside), np.flatnonzero(aside)
    surest = pool.surest if isinstance(pool, Pool) else lambda *views: _surest_of(pool, *views)
    given: list[tuple[list, np.ndarray]] = [([], np.zeros(0)), ([], np.zeros(0))]
    for r in range(rounds + 1):
        (t_rows, ty), (m_rows, my) = given
        text = TextView().fit([words[i] for i in use] + [x[:2] for x in t_rows], np.r_[y[use], ty])
        meta_view = MetaView().fit(np.concatenate([meta[use], np.array([x[2] for x in m_rows])]) if m_rows else meta[use], np.r_[y[use], my])
        t_scale = _calibrate(text.logit([words[i] for i in kept]), y[kept])
        m_scale = _calibrate(meta_view.logit(meta[kept]), y[kept])
        if r == rounds:
            break
        # each view hands on what it is sure about; at most as much of a class as the labelled rows have of it
        given = surest(text, t_scale, meta_view, m_scale, y[use], sure, r + 1, rounds)
    t = t_scale[0] * text.logit([words[i] for i in kept]) + t_scale[1]
    m = m_scale[0] * meta_view.logit(meta[kept]) + m_scale[1]
    mix = _logistic(np.c_[t, m] / 5, y[kept], ridge=0.05)
    mix = np.r_[np.maximum(mix[:2] / 5, 0), mix[2]]
    return Model(text, meta_view, t_scale, m_scale, mix if mix[:2].any() else np.array([1.0, 0.0, 0.0]))


def _surest_of(pool: list, text: TextView, t_scale, meta: MetaView, m_scale, y: np.ndarray, sure: float, r: int, rounds: int):
    """(rows, labels) of the pool for the text view, by the page view, and for the page view, by the text view."""
    if not pool:
        return [([], np.zeros(0))] * 2
    p_meta = _sigmoid(m_scale[0] * meta.logit(np.array([x[2] for x in pool])) + m_scale[1])
    p_text = _sigmoid(t_scale[0] * text.logit([x[:2] for x in pool]) + t_scale[1])
    chosen = [_confident(p, y, sure, r, rounds) for p in (p_meta, p_text)]
    return [([pool[i] for i in at], label) for at, label in chosen]


def _shares(y: np.ndarray, r: int, rounds: int) -> tuple[int, int]:
    """Pseudo-labels of the upper and of the lower class that a round hands on at most."""
    return int(y.sum() * r / rounds), int((1 - y).sum() * r / rounds)


def _confident(p: np.ndarray, y: np.ndarray, sure: float, r: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The surest pseudo-labels of each class, a share of the class's size that grows over the rounds."""
    up, down = np.argsort(-p, kind="stable"), np.argsort(p, kind="stable")
    most = _shares(y, r, rounds)
    up = up[p[up] >= sure][:most[0]]
    down = down[p[down] <= 1 - sure][:most[1]]
    return np.r_[up, down], np.r_[np.ones(up.size), np.zeros(down.size)]


# -- the jobs ----------------------------------------------------------------

_COLUMNS = ("source", "lang", "n_chars")


def _viewed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and metadata; metadata columns that the table lacks are null."""
    have = set(docs.columns)
    kinds = {"source": "string", "lang": "string", "n_chars": "long"}
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[
        (F.col(c) if c in have else F.lit(None)).cast(kinds[c]).alias(c) for c in _COLUMNS])


_PACKED = _CANDIDATES // 8


def _pack(slots: np.ndarray, make_up: np.ndarray, code: list[int], place: np.ndarray) -> bytes:
    """A document's candidate words as bits, its make-up and its metadata, in a fixed number of bytes."""
    bits = np.zeros(_CANDIDATES, bool)
    at = place[slots]
    bits[at[at >= 0]] = True
    return np.packbits(bits).tobytes() + make_up.tobytes() + np.array(code, np.int64).tobytes()


def _unpack(packed: list[bytes], candidates: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word slots, make-up, metadata) of packed documents; ``candidates`` is in order."""
    raw = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    bits = np.unpackbits(raw[:, :_PACKED], axis=1)[:, :candidates.size].astype(bool)
    cut = _PACKED + 8 * _MAKE_UP
    make_up = np.frombuffer(raw[:, _PACKED:cut].tobytes()).reshape(-1, _MAKE_UP)
    meta = _meta_matrix(np.frombuffer(raw[:, cut:].tobytes(), np.int64).reshape(-1, 3))
    return [(candidates[b], m, x) for b, m, x in zip(bits, make_up, meta)]


def _place(candidates: np.ndarray) -> np.ndarray:
    """Slot to its place among the candidates, else -1."""
    place = np.full(_SLOTS, -1, np.int16)
    place[candidates] = np.arange(candidates.size)
    return place


@dataclass
class Pool:
    """All unlabelled documents, as a stored table of packed features."""

    table: DataFrame
    candidates: np.ndarray

    def surest(self, text: TextView, t_scale, meta: MetaView, m_scale, y: np.ndarray, sure: float, r: int, rounds: int):
        """As ``_surest_of``, over the whole table: each task sends on its surest documents, and of these the surest are taken.

        Equal documents count once; ties are broken by a checksum.
        """
        candidates, most = self.candidates, _shares(y, r, rounds) * 2

        def order(found: dict[bytes, float], n: int) -> list[tuple[bytes, float]]:
            return sorted(found.items(), key=lambda x: (-x[1], zlib.crc32(x[0]), x[0]))[:n]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: list[dict[bytes, float]] = [{} for _ in most]
            floor = [sure] * len(most)
            for whole in batches:
                for at in range(0, whole.num_rows, 2000):
                    packed = whole.column(0).slice(at, 2000).to_pylist()
                    rows = _unpack(packed, candidates)
                    p_meta = _sigmoid(m_scale[0] * meta.logit(np.array([x[2] for x in rows])) + m_scale[1])
                    p_text = _sigmoid(t_scale[0] * text.logit([x[:2] for x in rows]) + t_scale[1])
                    for k, p in enumerate((p_meta, 1 - p_meta, p_text, 1 - p_text)):
                        p = np.round(p, 9)
                        for i in np.flatnonzero(p >= floor[k]).tolist():
                            best[k][packed[i]] = float(p[i])
                        if len(best[k]) > 2 * most[k] + 1000:
                            best[k] = dict(order(best[k], most[k]))
                            floor[k] = min(best[k].values(), default=2.0)
            rows = [(k, p, x) for k, n in enumerate(most) for x, p in order(best[k], n)]
            for at in range(0, len(rows), 5000):
                part = rows[at:at + 5000]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in part], t) for i, t in enumerate(
                    (pa.int32(), pa.float64(), pa.binary()))], ["kind", "p", "packed"])

        found = materialize(self.table.mapInArrow(run, "kind int, p double, packed binary"), "surest")
        # at most as many rows as the labelled sample has
        top = [found.where(F.col("kind") == k).distinct().orderBy(F.desc("p"), F.crc32("packed"), "packed").limit(n) for k, n in enumerate(most)]
        got = top[0].union(top[1]).union(top[2]).union(top[3]).collect()
        got.sort(key=lambda x: (x.kind, -x.p, zlib.crc32(x.packed), x.packed))
        out = []
        for kinds in ((0, 1), (2, 3)):
            mine = [x for x in got if x.kind in kinds]
            out.append((_unpack([x.packed for x in mine], candidates) if mine else [], np.array([float(x.kind == kinds[0]) for x in mine])))
        return out


def _candidate_words(labelled: DataFrame) -> np.ndarray:
    """The slots that differ most between the classes by chi-square, in order; counted by the executors."""
    fitted = labelled.where("not aside")
    n, n1 = fitted.agg(F.count("*"), F.sum("good")).first()
    seen = fitted.select("good", F.explode("words").alias("slot")).groupBy("slot").agg(F.sum("good").alias("a"), F.count("*").alias("n"))
    a, b = F.col("a").cast("double"), (F.col("n") - F.col("a")).cast("double")
    c, d = F.lit(float(n1 or 0)) - a, F.lit(float(n - (n1 or 0))) - b
    gap = F.greatest(F.lit(0.0), F.abs(a * d - b * c) - n / 2)
    chi2 = F.coalesce(F.try_divide(gap * gap, (a + b) * (c + d) * (a + c) * (b + d)), F.lit(0.0))
    best = seen.select("slot", chi2.alias("chi2")).orderBy(F.desc("chi2"), "slot").limit(_CANDIDATES).collect()
    return np.sort(np.array([x.slot for x in best], np.int32))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, sure: float = SURE) -> Model | None:
    """Fits on at most ``max_labelled`` labelled documents, chosen by a hash of their id, and on all others as far as the views are sure of them.

    ``labels`` has (id_col, quality, toxic); a document is good if its quality
    is 1 and it is not toxic.  Rows with a null id or quality are left out, of
    contradicting labels the worse one counts, of rows with the same id the one with the least hash.
    Documents with a null id are unlabelled; equal documents are one pseudo-label.  None, and a warning,
    if there is nothing to learn from.
    """
    good = F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("good")
    ids = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("id")).agg(good)
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    viewed = _viewed(docs, id_col, text_col)
    rows = viewed.join(F.broadcast(chosen), "id").select(
        "id", F.xxhash64("text", *_COLUMNS).alias("h"), (F.pmod(F.xxhash64("id", F.lit("aside")), F.lit(_CALIBRATION_SHARE)) == 0).alias("aside"), "good", "text", *_COLUMNS)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {}  # id to its row of the least hash in this task; at most the sample's ids
        kind = None
        for b in batches:
            kind = b.column(0).type
            for id_, h, aside, good, text, *known in zip(*[c.to_pylist() for c in b.columns]):
                if id_ not in least or h < least[id_][0]:
                    s, m = text_features(text)
                    least[id_] = h, aside, good, s, m.tobytes(), _meta_code(*known)
        found = list(least.items())
        for at in range(0, len(found), 500):
            part = found[at:at + 500]
            types = (pa.int64(), pa.bool_(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in part], kind), *[pa.array(x, t) for x, t in zip(zip(*[v for _, v in part]), types)]],
                ["id", "h", "aside", "good", "words", "make_up", "meta"])

    id_type = docs.schema[id_col].dataType.simpleString()
    seen = rows.mapInArrow(features, f"id {id_type}, h long, aside boolean, good int, words array<int>, make_up binary, meta array<long>")
    # one row for each id, so at most max_labelled
    labelled = materialize(seen.groupBy("id").agg(
        F.min_by(F.struct("aside", "good", "words", "make_up", "meta"), "h").alias("r")).select("r.*"), "labelled")
    if labelled.select("aside", "good").distinct().count() < 4:
        logging.getLogger(__name__).warning("no quality model: a class has too few labelled documents; every document is kept")
        return None
    candidates = _candidate_words(labelled)
    shared = docs.sparkSession.sparkContext.broadcast(candidates)  # at most _CANDIDATES numbers

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _place(shared.value)
        for b in batches:
            aside, good, words, make_up, meta = (c.to_pylist() for c in b.columns)
            packed = [_pack(np.array(w, np.int32), np.frombuffer(m), x, place) for w, m, x in zip(words, make_up, meta)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], ["aside", "good", "packed"])

    got = labelled.mapInArrow(pack, "aside boolean, good int, packed binary").collect()  # some 400 bytes each
    got.sort(key=lambda r: (r.packed, r.aside, r.good))

    def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _place(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                packed = [_pack(*text_features(text), _meta_code(*known), place) for text, *known in zip(*[c.to_pylist() for c in b.columns[1:]])]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], ["id", "packed"])

    if ids.count() <= BROADCAST_ROWS:
        others = viewed.join(F.broadcast(ids.select("id")), "id", "left_anti").mapInArrow(pack_texts, f"id {id_type}, packed binary")
    else:  # what is shuffled are packed rows, not texts
        others = viewed.mapInArrow(pack_texts, f"id {id_type}, packed binary").join(ids.select("id"), "id", "left_anti")
    pool = Pool(materialize(others.select("packed"), "unlabelled"), candidates)
    y = np.array([float(r.good) for r in got])
    aside = np.array([bool(r.aside) for r in got], bool)
    return co_train(_unpack([r.packed for r in got], candidates), y, aside, pool, rounds, sure)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` and ``quality_text``, ``quality_meta``, ``quality_score`` and ``quality_keep``.

    Columns of those names are replaced.  A null text counts as empty and null
    metadata as a value of its own.  Without a model every score is null and
    every document is kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred weights
    old = [c for c in docs.columns if c not in ("quality_text", "quality_meta", "quality_score", "quality_keep")]
    base = docs.select(*old)
    # the text goes to the executors' Python within its row, not a second time beside it
    text_at = [c.lower() for c in old].index(text_col.lower())
    packed = base.select(F.struct(*old).alias("row"),
                         *[(F.col(c) if c in old else F.lit(None)).cast(k).alias(c)
                           for c, k in zip(_COLUMNS, ("string", "string", "long"))])
    row_type = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                if m is None:
                    none = pa.nulls(b.num_rows, pa.float64())
                    out = [none, none, none]
                else:
                    texts = b.column(0).field(text_at).to_pylist()
                    source, lang, n_chars = [c.to_pylist() for c in b.columns[1:]]
                    meta = _meta_matrix(np.array([_meta_code(*x) for x in zip(source, lang, n_chars)]).reshape(-1, 3))
                    out = [pa.array(s) for s in m.scores([text_features(t) for t in texts], meta)]
                yield pa.RecordBatch.from_arrays([b.column(0), *out], ["row", "quality_text", "quality_meta", "quality_score"])

    got = packed.mapInArrow(run, f"row {row_type}, quality_text double, quality_meta double, quality_score double")
    return got.select("row.*", "quality_text", "quality_meta", "quality_score",
                      F.coalesce(F.col("quality_score") >= threshold, F.lit(True)).alias("quality_keep"))
