"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame operations only.

The sketch of a set of shingles is its ``k`` least hashes, in order.  The sketch of a union is
made from the sketches of its parts, so a document may be sketched in parts
and a collection from its documents.  Two sketches give the resemblance
(Jaccard similarity) and containment of their sets, and one the number of its
distinct shingles.  A set of fewer than ``k`` shingles is held whole, so its
figures are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW_KEY, cut_lineage, materialize, with_row_key

K = 128
SHINGLE_WORDS = 5
_BREAK = r"[\x20\x09-\x0D]+"
#: Sketches merged in one step of a group.
_FAN_IN = 64


def with_sketch(df: DataFrame, text_col: str, out_col: str, k: int = K, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` and the sketch of a text column: the ``k`` least distinct hashes of its word shingles.

    Words are what ASCII white space separates, unchanged.  A text of fewer
    words is one shingle; without words, or null, it has the empty sketch.
    """
    keep = [c for c in df.columns if c != out_col]
    cut = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), _BREAK), lambda w: w != "")
    # the hashes are a column of their own, referred to several times: they are not worked out again for each shingle
    hashed = df.select(*keep, F.transform(cut, lambda w: F.xxhash64(w)).alias("_w"))
    w, n = F.col("_w"), F.size("_w")
    runs = F.transform(F.sequence(F.lit(0), n - shingle_words),
                       lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(shingle_words)]))
    grams = F.when(n >= shingle_words, runs).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    return hashed.select(*keep, F.slice(F.sort_array(F.array_distinct(grams)), 1, k).alias(out_col))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct(a: Column, k: int = K) -> Column:
    """Number of distinct shingles; exact below ``k``."""
    place = F.element_at(a, -1) / F.lit(2.0**64) + 0.5  # of the k-th least hash, between 0 and 1
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the union's sketch that is in both; 1 for two empty sets."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / F.size(union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of the first set that is in the second; 1 if the first is empty."""
    part = resemblance(a, b, k) * distinct(merged(a, b, k), k) / distinct(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(part, F.lit(1.0)))


def as_text(a: Column) -> Column:
    """Sixteen hexadecimal digits for each hash of a sketch."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merge_groups(df: DataFrame, group: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """(group, sketch_col): the sketch of each group's union.

    Merged in rounds of about ``_FAN_IN`` sketches, so that a group of any size
    never meets in one task.  Null sketches count as empty.
    """
    part = df.select(*group, F.coalesce(sketch_col, F.array().cast("array<bigint>")).alias(sketch_col))
    while True:
        largest = part.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
        salts = -(-largest // _FAN_IN)
        salted = part.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, salts))))
        part = salted.groupBy(*group, "_salt").agg(F.collect_list(sketch_col).alias("_all")).select(*group, F.aggregate(
            "_all", F.array().cast("array<bigint>"), lambda s, x: merged(s, x, k)).alias(sketch_col))
        if salts <= 1:
            return part
        part = cut_lineage(part)


# -- a document and the one after it -----------------------------------------

def followers(keys: DataFrame, order: list[str], payload: list[str]) -> DataFrame:
    """(order and payload columns, next_*): each row and the next in order; the first follows the last.

    Rows are cut into range partitions, which are small enough to sort; the
    first rows of the partitions, one each, close the gaps between them.
    """
    cols = [*order, *payload]
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written out: range bounds are sampled, and must not be drawn again
    cut = materialize(keys.select(*cols).repartitionByRange(n, *order).withColumn("_piece", F.spark_partition_id()), "order")
    row = F.struct(*cols)
    firsts = cut.groupBy("_piece").agg(F.min(row).alias("_first"))
    # one row for each of the partitions
    heads = firsts.select(F.col("_piece").alias("_p"), F.coalesce(
        F.lead("_first").over(Window.orderBy("_piece")), F.first("_first").over(Window.orderBy("_piece"))).alias("_after"))
    inside = cut.withColumn("_next", F.lead(row).over(Window.partitionBy("_piece").orderBy(*order)))
    joined = inside.join(F.broadcast(heads), F.col("_piece") == F.col("_p"))
    after = F.coalesce("_next", "_after")
    return joined.select(*cols, *[after[c].alias(f"next_{c}") for c in cols])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                        shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id_col, n_chars, edited, sketch, edited_sketch, next_id, next_sketch) of each document.

    ``edited`` is the text with its last floor(n_chars / 2) characters replaced
    by as many from the front of the next document (all, if it is shorter), in ascending order of the id;
    the first follows the last, and a lone document itself.  Null ids come
    first, equal ids follow one another in the table's order.  A null text is
    empty.  Other columns are ignored.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = with_row_key(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), ["id", "text"])
    pairs = followers(base.select(ROW_KEY, "id", F.length("text").alias("n")), ["id", ROW_KEY], ["n"])
    wanted = pairs.select(F.col(f"next_{ROW_KEY}").alias(ROW_KEY), F.col(ROW_KEY).alias("to"), F.floor(F.col("n") / 2).cast("int").alias("need"))
    # One exchange of the texts serves both the documents that give and those that take, as
    # both sides use the same columns of it.
    placed = base.repartition(n, ROW_KEY)
    given = with_sketch(placed.join(wanted.repartition(n, ROW_KEY), ROW_KEY), "text", "next_sketch", k, shingle_words).select(
        F.col("to").alias(ROW_KEY), F.col("id").alias("next_id"), F.expr("substring(text, 1, need)").alias("head"), "next_sketch")
    both = placed.join(given.repartition(n, ROW_KEY), ROW_KEY)
    size = F.length("text")
    # what a text keeps is the rest: the longer half
    both = both.select("id", size.cast("long").alias("n_chars"), "text", "next_id", "next_sketch", F.concat(
        F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), "head").alias("edited"))
    both = with_sketch(both, "text", "sketch", k, shingle_words).drop("text")
    both = with_sketch(both, "edited", "edited_sketch", k, shingle_words)
    return both.withColumnRenamed("id", id_col).select(id_col, "n_chars", "edited", "sketch", "edited_sketch", "next_id", "next_sketch")
