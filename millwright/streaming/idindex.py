"""Index of stored event ids (ST-2, SRC-6): a micro-batch reads the partitions that may hold its ids, and no others.

Ids are stored by micro-batch and hash bucket.  Beside each such partition lies
a Bloom filter with one hash function, as bitmap pages that Spark's bitmap
aggregates make.  A lookup tests the OR of all filters first; ids that pass are
tested against the filters of the single partitions, and only partitions with a
hit are read.  New ids, the usual case, cost a look at filters of about two bytes an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .jobs import earlier_batches

#: Bits of a bitmap page, as Spark's bitmap functions have it.
PAGE_BITS = 32_768


class IdIndex:
    """``buckets``: hash partitions of a micro-batch's ids; ``filter_bits``: bits of the filter of each."""

    def __init__(self, root: str, key: str = "event_id", buckets: int = 16, filter_bits: int = 4 * PAGE_BITS):
        self.ids, self.filters = f"{root}/ids", f"{root}/filters"
        self.key, self.buckets, self.filter_bits = key, buckets, filter_bits

    def _placed(self, rows: DataFrame) -> DataFrame:
        """(key, bucket, page, bit) of each distinct id."""
        key = F.col(self.key)
        slot = F.pmod(F.xxhash64(F.lit("filter"), key), F.lit(self.filter_bits)) + 1
        return rows.where(key.isNotNull()).select(self.key).distinct().select(
            self.key, F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int").alias("bucket"),
            F.bitmap_bucket_number(slot).alias("page"), F.bitmap_bit_position(slot).alias("bit"))

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Stores the ids of a micro-batch; the same micro-batch again replaces itself."""
        placed = self._placed(rows)
        placed.select(self.key, "bucket").repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.ids}/batch_id={batch_id}")
        placed.groupBy("bucket", "page").agg(F.bitmap_construct_agg("bit").alias("bits")).write.mode("overwrite").parquet(
            f"{self.filters}/batch_id={batch_id}")

    @staticmethod
    def _is_set(bits: Column, bit: Column) -> Column:
        octet = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return (F.floor(octet / F.pow(F.lit(2), bit % 8)) % 2) == 1

    def partitions(self, rows: DataFrame, batch_id: int) -> list[tuple[int, int]]:
        """(micro-batch, bucket) of the partitions before ``batch_id`` that may hold an id of ``rows``."""
        if batch_id == 0:
            return []
        filters = rows.sparkSession.read.parquet(self.filters).where(F.col("batch_id") < batch_id)
        every = filters.groupBy("bucket", "page").agg(F.bitmap_or_agg("bits").alias("bits"))
        maybe = self._placed(rows).join(every, ["bucket", "page"]).where(self._is_set(F.col("bits"), F.col("bit"))).drop("bits")
        hit = maybe.join(filters, ["bucket", "page"]).where(self._is_set(F.col("bits"), F.col("bit")))
        # names of partitions, as in a listing of files
        return sorted((r.batch_id, r.bucket) for r in hit.select("batch_id", "bucket").distinct().collect())

    def stored(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """The stored ids of the partitions that may hold an id of ``rows``."""
        spark: SparkSession = rows.sparkSession
        found = self.partitions(rows, batch_id)
        if not found:
            return rows.select(self.key).limit(0)
        paths = [f"{self.ids}/batch_id={b}/bucket={k}" for b, k in found]
        return spark.read.schema(rows.select(self.key).schema).parquet(*paths)


def stored_ids(path: str, batch: DataFrame, batch_id: int, key: str, index: IdIndex | None) -> DataFrame:
    """What a micro-batch's ids are held against: the index, or the whole sink without one."""
    return index.stored(batch, batch_id) if index else earlier_batches(batch, path, batch_id).select(key)
