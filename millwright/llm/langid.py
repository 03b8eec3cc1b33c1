"""Language identification by string kernels.

A text is the set of its character n-grams of 1 to 4 letters (blended
spectrum, presence only).  The kernel of two texts is the cosine of their
sets.  A Nystroem map onto landmark texts makes kernel ridge regression, one
classifier per language, a product of two small matrices, so every text of
any length is scored in one pass and in batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: n-gram sets are hashed to this many slots; texts of a few thousand n-grams look alike by some hundredths through collisions.
SLOTS = 1 << 16
#: Texts whose sets are one matrix at a time.
BATCH = 256
ORDERS = (1, 2, 3, 4)
LANDMARKS = 96
#: Texts that the classifier is fitted on, at most, shared evenly among languages; but LEAST_ROWS of each language, however many there are.
FIT_ROWS = 2_000
LEAST_ROWS = 4
#: Ridge penalty.
RIDGE = 1e-2
UNKNOWN = "und"
_MULT = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 18


def slots(text: str) -> np.ndarray:
    """Sorted slots of the n-grams of the whole text; letters are lower-cased, other characters are word breaks."""
    seen = np.zeros(SLOTS, bool)
    low = text.lower()
    codes = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
    for at in range(0, codes.size, _PIECE):
        piece = codes[at:at + _PIECE + max(ORDERS) - 1]
        letters = _letters(piece)
        keep = letters | np.r_[True, letters[:-1]]  # a run of other characters is one break
        c = np.where(letters, piece, 32)[keep].astype(np.uint64)
        h = np.zeros(c.size, np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if c.size < n:
                break
            h = (h[:c.size - n + 1] + c[n - 1:] + np.uint64(n)) * _MULT
            h ^= h >> np.uint64(29)
            if n in ORDERS:
                seen[(h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)] = True
    return np.flatnonzero(seen)


_KNOWN = np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x10000)])


def _letters(codes: np.ndarray) -> np.ndarray:
    high = codes >= 0x10000
    out = _KNOWN[np.where(high, 0, codes)]
    if high.any():
        out[high] = [chr(c).isalpha() for c in codes[high].tolist()]
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and (text.isalpha() or any(map(str.isalpha, text)))


def presence(sets: list[np.ndarray]) -> np.ndarray:
    """Rows of unit length of n-gram sets, which are lists of slots."""
    x = np.zeros((len(sets), SLOTS), np.float32)
    for i, s in enumerate(sets):
        if s.size:
            x[i, s] = 1 / np.sqrt(s.size)
    return x


@dataclass
class Model:
    langs: list[str]
    landmarks: np.ndarray  # (slots, landmarks)
    weights: np.ndarray    # (landmarks, languages); the Nystroem map and the ridge weights in one
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        return presence([slots(t) for t in texts]) @ self.landmarks @ self.weights + self.bias


def fit(sets: list[np.ndarray], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nystroem kernel ridge regression, one against the rest, on (slots of a text, language) rows in any order."""
    names = sorted(set(langs))
    # landmarks in turn from each language, so that each has its share
    rows = {n: [i for i, v in enumerate(langs) if v == n] for n in names}
    chosen = [rows[n][k] for k in range(max(map(len, rows.values()), default=0)) for n in names if k < len(rows[n])]
    z = presence([sets[i] for i in chosen[:landmarks]])
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    kernel = np.concatenate([presence(sets[i:i + BATCH]) @ z.T for i in range(0, len(sets), BATCH)])
    phi = kernel.astype(np.float64) @ root
    y = np.array([[1.0 if v == n else -1.0 for n in names] for v in langs]).reshape(len(langs), len(names))
    share = (y > 0).mean(axis=0)
    weight = (y > 0) / np.maximum(share, 1e-9) / len(names) if names else y
    w = weight.sum(axis=1, keepdims=True)  # every language counts the same
    mean_x, mean_y = (phi * w).sum(0) / w.sum(), (y * w).sum(0) / w.sum()
    a, b = phi - mean_x, y - mean_y
    beta = np.linalg.solve((a * w).T @ a / len(langs) + ridge * np.eye(a.shape[1]), (a * w).T @ b / len(langs))
    return Model(names, np.ascontiguousarray(z.T), (root @ beta).astype(np.float32), (mean_y - mean_x @ beta).astype(np.float32))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Fits on at most ``fit_rows`` labelled rows, or ``LEAST_ROWS`` of each language if that is more, spread evenly over
    languages and chosen by hash of the id.

    Every language can be predicted.  Of rows with the same language and id the one with the least hash of its text counts.
    The driver gets n-gram sets as bits, 8 KB for a text of any length.  None if no row has a text and a language.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                       F.col(id_col).cast("string").alias("id")).where("lang is not null and text is not null")
    n = rows.select("lang").distinct().count()
    if not n:
        return None
    each = max(LEAST_ROWS, fit_rows // n)
    # the first of each language in parts, then of these: no language is sorted in one task
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.where("id is not null").select("lang", "id", F.xxhash64("id").alias("h")).distinct().withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(parts)))
    for by in (["lang", "part"], ["lang"]):
        first = F.row_number().over(Window.partitionBy(*by).orderBy("h", "id"))
        keys = keys.withColumn("at", first).where(F.col("at") <= each).drop("at")
    kept = rows.join(F.broadcast(keys.select("lang", "id")), ["lang", "id"]).groupBy("lang", "id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                found = [x for x in zip(*[c.to_pylist() for c in whole.slice(at, BATCH).columns]) if has_letter(x[2])]
                bits = []
                for _, _, text in found:
                    seen = np.zeros(SLOTS, bool)
                    seen[slots(text)] = True
                    bits.append(np.packbits(seen).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string()),
                                                  pa.array(bits, pa.binary())], ["lang", "id", "bits"])

    got = kept.select("lang", "id", "text").mapInArrow(sets, "lang string, id string, bits binary").collect()
    got.sort(key=lambda r: (r.id, r.lang, r.bits))
    found = [np.flatnonzero(np.unpackbits(np.frombuffer(r.bits, np.uint8))) for r in got]
    return fit(found, [r.lang for r in got], landmarks, ridge) if got else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score): the best language and its score, clipped to 0 to 1.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text if there is no model.  Only the text is looked at.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)  # at most LANDMARKS x SLOTS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                texts = b.column(1).to_pylist()
                lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                real = [i for i, t in enumerate(texts) if m is not None and has_letter(t)]
                if real:
                    s = m.scores([texts[i] for i in real])
                    for i, k, v in zip(real, s.argmax(axis=1), s.max(axis=1)):
                        lang[i], score[i] = m.langs[k], float(min(1.0, max(0.0, (v + 1) / 2)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 ["id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col)
