"""Benchmark decontamination by winnowing, in DataFrame operations only.

Texts are words; the hashes of ``gram`` consecutive words are winnowed: of any
``window - gram + 1`` in a row the least one is kept with its place (the first
of equal ones).  A window of ``window`` words that a document and an item
share has the same least hash at the same place of both, so joining the kept
fingerprints finds an alignment through every shared window: no shared span
of at least that length is missed.  Each alignment is then extended by comparing
the words themselves, so no hash decides a hit.

An item with fewer words than the window is one window of its own length; for
each such length (at most ``window - 1``) the hash of every run of that many
words takes the place of the winnowed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW_KEY, materialize, with_row_key

WINDOW = 10
GRAM = 5
#: Rows of item fingerprints up to which they are broadcast; more are shuffled.
BROADCAST_ROWS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased runs of digits, letters and characters outside ASCII; none for null."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAK)
    return F.filter(cut, lambda w: w != "")


def _upto(n: Column) -> Column:
    """0 to n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(hashes: str, n: int) -> Column:
    """Hash of the ``n`` words from each place on, from the column of word hashes."""
    h = F.col(hashes)
    return F.transform(_upto(F.size(h) - n + 1), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(n)]))


def _runs(n: int) -> Column:
    """A fingerprint of every run of ``n`` words."""
    return F.transform(_upto(F.size("h") - n + 1), lambda i: F.struct(
        F.lit(n).alias("length"), F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(n)]).alias("fp"), i.alias("at")))


def fingerprints(texts: DataFrame, keep: list[str], window: int, gram: int, short: list[int]) -> DataFrame:
    """(keep, length, fp, at): winnowed fingerprints of the ``words`` column, and those for short items.

    ``length`` is the window that a fingerprint is for.
    """
    # each step is a column that the next refers to more than once, so that no step is worked out anew for every word
    hashed = texts.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    grams = hashed.select(*keep, "h", _gram_hashes("h", gram).alias("g"))
    row = window - gram + 1

    def least(i: Column) -> Column:
        part = F.slice(F.col("g"), i + 1, row)
        return i + F.array_position(part, F.array_min(part)).cast("int") - 1

    places = grams.select(*keep, "h", "g", F.array_distinct(
        F.transform(_upto(F.size("g") - row + 1), least)).alias("places"))
    found = [F.transform("places", lambda p: F.struct(F.lit(window).alias("length"), F.get(F.col("g"), p).alias("fp"), p.alias("at")))]
    found += [_runs(n) for n in short]
    return places.select(*keep, F.explode(F.concat(*found) if short else found[0]).alias("f")).select(*keep, "f.*")


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id_col, row key, n_words, n_hit, items, hits): words of each document in windows of benchmark items.

    ``items`` are the ids (as strings, sorted; an item for each row of the
    table) whose windows occur, ``hits`` the places of the words hit.  Texts
    without words, null ones too, hit nothing.  Rows with equal or null ids
    stay rows of their own; null item ids count but are not listed.  Other
    columns are ignored.
    """
    base = with_row_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"])
    wanted = with_row_key(items.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).alias("text")),
                          ["item_id", "text"])
    wanted = materialize(wanted.select(F.col(ROW_KEY).alias("item"), "item_id", words(F.col("text")).alias("words"))
                         .where(F.size("words") > 0).withColumn("n", F.size("words")), "items")
    # at most window - 1 numbers
    short = sorted(r.n for r in wanted.where(F.col("n") < window).select("n").distinct().collect())
    marks = fingerprints(wanted.where(F.col("n") >= window), ["item", "n"], window, gram, [])
    for n in short:
        marks = marks.union(fingerprints(wanted.where(F.col("n") == n), ["item", "n"], window, gram, [n]).where(F.col("length") == n))
    marks = materialize(marks.withColumnsRenamed({"at": "item_at"}), "item_marks")
    bounded = marks.count() <= BROADCAST_ROWS
    small = F.broadcast if bounded else lambda df: df

    marked = fingerprints(base.select(ROW_KEY, words(F.col("text")).alias("words")), [ROW_KEY], window, gram, short)
    lines = marked.join(small(marks), ["length", "fp"]).select(
        ROW_KEY, F.struct("item", "n", (F.col("at") - F.col("item_at")).alias("shift")).alias("line"))
    lines = lines.groupBy(ROW_KEY).agg(F.collect_set("line").alias("lines"))

    # the part of the document that lies along the item: word i of the item against word shift + i
    held = base.select(ROW_KEY, "text").join(lines, ROW_KEY).select(ROW_KEY, words(F.col("text")).alias("words"), "lines")
    along = held.select(ROW_KEY, F.explode(F.transform("lines", lambda c: F.struct(
        c["item"].alias("item"), c["shift"].alias("shift"), F.greatest(-c["shift"], F.lit(0)).alias("skip"),
        F.slice(F.col("words"), F.greatest(c["shift"], F.lit(0)) + 1, c["n"] + F.least(c["shift"], F.lit(0))).alias("part")))).alias("c"))
    along = along.select(ROW_KEY, "c.*").join(small(wanted), "item")
    same = along.select(ROW_KEY, "item", "item_id", "shift", "skip", F.least("n", F.lit(window)).alias("length"), F.transform(
        F.arrays_zip(F.col("part").alias("a"), F.slice(F.col("words"), F.col("skip") + 1, F.size("part")).alias("b")),
        lambda p: p["a"].eqNullSafe(p["b"])).alias("same"))
    starts = same.select(ROW_KEY, "item", "item_id", "length", (F.col("shift") + F.col("skip")).alias("base"), F.filter(
        _upto(F.size("same") - F.col("length") + 1),
        lambda i: F.forall(F.slice(F.col("same"), i + 1, F.col("length")), lambda x: x)).alias("starts"))
    hit = starts.where(F.size("starts") > 0).select(ROW_KEY, "item", "item_id", F.array_distinct(F.flatten(F.transform(
        "starts", lambda s: F.sequence(F.col("base") + s, F.col("base") + s + F.col("length") - 1)))).alias("hits"))
    hit = hit.groupBy(ROW_KEY, "item", "item_id").agg(F.flatten(F.collect_list("hits")).alias("hits")).groupBy(ROW_KEY).agg(
        F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"))
    all_ = base.select(ROW_KEY, "id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return all_.join(hit, ROW_KEY, "left").select(
        F.col("id").alias(id_col), ROW_KEY, "n_words", F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"))
