"""Ordered per-group computations that never put a whole group in one task.

Every ordered operator in this engine (lag/lead, trailing row frames, runs of
equal values, as-of carry-forward) looks only a bounded number of rows back or
ahead, or carries one value forward.  A plain ``Window.partitionBy(key)``
would still sort each key's full history in one task, and one machine may hold
a third of all rows.  So:

1. ``sequence_index`` gives each row its 0-based position ``_seq`` within its
   key, ordered by (order columns, the first being a timestamp).  It cuts each
   key into order-contiguous pieces -- range partitions on (key, order) by
   default, so a hot key, a hot hour or a heap of same-instant copies is split
   by sampled bounds; fixed time buckets as a cheaper option -- ranks rows
   inside each (key, piece), checkpoints that, then adds per-piece offsets
   computed from a small (key, piece, count) summary.
2. ``chunked`` cuts each key's sequence into chunks of ``chunk_rows`` and
   copies the few rows a window needs from the neighbouring chunk ("halo").
   Windows then run over ``partitionBy(key, _chunk)``: bounded and exact.
3. ``fill_forward`` carries the last non-null value forward across chunks via
   a per-chunk summary, so even unbounded-preceding semantics stay bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

NULL_KEY = "\u0000"
DEFAULT_CHUNK_ROWS = 1_000_000


def _fill(df: DataFrame, keys: list[str]) -> DataFrame:
    # Null keys form their own group (as in the source system); a sentinel lets
    # them take part in plain equi-joins and hash partitioning.
    return df.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY)) for k in keys})


def _restore(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumns({k: F.when(F.col(k) == NULL_KEY, F.lit(None).cast("string")).otherwise(F.col(k))
                           for k in keys})


def _order_cols(order: list) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order]


DEFAULT_BUCKET_SECONDS = 3600
_NULL_BUCKET = 2**62  # rows without a timestamp sort last, as in the source system


def _bucket(order: list, bucket_seconds: int) -> Column:
    first = order[0]
    ts = F.col(first) if isinstance(first, str) else first
    b = F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(bucket_seconds * 1_000_000)).cast("long")
    return F.coalesce(b, F.lit(_NULL_BUCKET).cast("long"))


SPLIT_MODES = ("range", "bucket")
DEFAULT_SPLIT = "range"


#: Rows of a range piece above which the pieces are cut anew, and those that a piece then has.
MAX_PIECE_ROWS = 4_000_000
PIECE_ROWS = 1_000_000


def _pieces(df: DataFrame) -> int:
    """Range pieces to begin with: the session's shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _split_column(df: DataFrame, keys: list[str], order: list, split: str, bucket_seconds: int,
                  pieces: int | None = None) -> DataFrame:
    """Attach ``_p``: a split of each key into order-contiguous pieces.

    ``range``: ``repartitionByRange`` on (key, order...) -- sampled bounds cut a
    hot key, a hot hour and even a pile of same-timestamp copies (the id is part
    of the range key) into balanced pieces; ``_p`` is the range partition.
    ``bucket``: a fixed time bucket of the first order column (no sampling job,
    but one busy (key, bucket) is ranked in one task).
    """
    if split == "range":
        ranged = df.repartitionByRange(pieces or _pieces(df), *[F.col(k) for k in keys], *_order_cols(order))
        return ranged.withColumn("_p", F.spark_partition_id().cast("long"))
    if split == "bucket":
        return df.withColumn("_p", _bucket(order, bucket_seconds))
    raise ValueError(f"split must be one of {SPLIT_MODES}")


def sequence_index(df: DataFrame, keys: list[str], order: list,
                   bucket_seconds: int = DEFAULT_BUCKET_SECONDS, split: str | None = None) -> DataFrame:
    """Add ``_seq`` (0-based row position within ``keys`` by ``order``).

    Keys come back with nulls replaced by a sentinel; callers finish with
    ``restore_keys``.  ``order`` must be unique within a key (end it with an id)
    and start with the timestamp column.
    """
    oc = _order_cols(order)
    conf = df.sparkSession.conf
    split = split or conf.get("millwright.sequence.split", None) or DEFAULT_SPLIT
    bucket_seconds = int(conf.get("millwright.sequence.bucketSeconds", str(bucket_seconds)))
    filled = _fill(df, keys)
    w = Window.partitionBy(*keys, "_p")
    # Rank and piece size in one windowed pass (one shuffle, one sort), then
    # checkpointed.  Both the offsets and the final join read the checkpoint,
    # so ``_p`` is computed exactly once -- a range partition id recomputed in
    # a second plan branch could differ (its bounds come from sampling) -- and
    # nothing upstream runs twice.
    def ranked(pieces: int | None = None) -> DataFrame:
        b = _split_column(filled, keys, order, split, bucket_seconds, pieces)
        return cut_lineage(b.withColumn("_lrn", F.row_number().over(w.orderBy(*oc)) - 1)
                           .withColumn("_n", F.count(F.lit(1)).over(w)))

    local = ranked()
    if split == "range":
        # the rows are counted now: too few pieces for them are cut again, by the count
        sizes = local.where(F.col("_lrn") == 0).groupBy("_p").agg(F.sum("_n").alias("n"))
        most = sizes.agg(F.max("n").alias("largest"), F.sum("n").alias("rows")).first()
        if (most["largest"] or 0) > MAX_PIECE_ROWS and -(-most["rows"] // PIECE_ROWS) > _pieces(df):
            local = ranked(-(-most["rows"] // PIECE_ROWS))
    # One row per (key, piece): small next to the data.
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = (local.where(F.col("_lrn") == 0)
            .select(*keys, "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    return (local.join(offs, [*keys, "_p"])
            .withColumn("_seq", (F.col("_off") + F.col("_lrn")).cast("long"))
            .drop("_off", "_lrn", "_p", "_n"))


def chunked(df: DataFrame, keys: list[str], order: list, before: int, after: int = 0,
            chunk_rows: int = DEFAULT_CHUNK_ROWS, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Sequence rows and lay them out in chunks with halo rows.

    Output adds ``_seq``, ``_chunk`` and ``_halo``.  Window with
    ``chunk_window(keys)``, compute, then ``finish(df, keys)`` drops halo rows.
    A row at position ``p`` of its chunk sees every row in ``[p-before,
    p+after]`` of its key.
    """
    if chunk_rows < max(before, after, 1):
        raise ValueError("chunk_rows must be at least the halo size")
    s = sequence_index(df, keys, order, bucket_seconds)
    c = F.floor(F.col("_seq") / chunk_rows).cast("long")
    pos = F.col("_seq") - c * chunk_rows
    targets = [F.struct(c.alias("_chunk"), F.lit(False).alias("_halo"))]
    if before > 0:
        targets.append(F.when(pos >= chunk_rows - before,
                              F.struct((c + 1).alias("_chunk"), F.lit(True).alias("_halo"))))
    if after > 0:
        targets.append(F.when((pos < after) & (c > 0),
                              F.struct((c - 1).alias("_chunk"), F.lit(True).alias("_halo"))))
    return (s.withColumn("_t", F.explode(F.array_compact(F.array(*targets))))
            .select("*", "_t._chunk", "_t._halo").drop("_t"))


def chunk_window(keys: list[str]) -> Window:
    return Window.partitionBy(*keys, "_chunk").orderBy("_seq")


def finish(df: DataFrame, keys: list[str]) -> DataFrame:
    return restore_keys(df.where(~F.col("_halo")).drop("_halo", "_chunk", "_seq"), keys)


def restore_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return _restore(df, keys)


def fill_forward(df: DataFrame, keys: list[str], order: list, value: Column, name: str,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS,
                 bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``name`` = last non-null ``value`` at or before each row (per key).

    Equivalent to ``last(value, ignorenulls) over (partition by keys order by
    order rows unbounded preceding)`` but bounded: within a chunk the window
    runs as usual; the value carried in from earlier chunks comes from a
    per-chunk summary (one row per key and chunk).
    """
    s = sequence_index(df.withColumn("_v", value), keys, order, bucket_seconds)
    s = s.withColumn("_chunk", F.floor(F.col("_seq") / chunk_rows).cast("long"))
    wc = Window.partitionBy(*keys, "_chunk")
    inside = cut_lineage(
        s.withColumn("_vin", F.last("_v", ignorenulls=True).over(
            wc.orderBy("_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
         .withColumn("_is_last", F.col("_seq") == F.max("_seq").over(wc)))
    # Value entering chunk c = last value of the nearest earlier chunk that had
    # one: per-chunk last values (one row per key and chunk, taken from the
    # chunk's last row), shifted by one chunk and filled forward.
    summary = (inside.where("_is_last")
               .withColumn("_vprev", F.last("_vin", ignorenulls=True).over(
                   Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)))
               .select(*keys, "_chunk", "_vprev"))
    return (inside.join(summary, [*keys, "_chunk"], "left")
            .withColumn(name, F.coalesce(F.col("_vin"), F.col("_vprev")))
            .drop("_v", "_vin", "_vprev", "_chunk", "_is_last"))
