"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, materialize

__all__ = ["ROW_KEY", "binary_column", "cut_lineage", "materialize", "read_table", "with_row_key"]

#: Name of the surrogate key that operators with a join on documents add.
ROW_KEY = "_row_key"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns and a key that tells rows apart even if ``doc_id`` is null or repeated.

    The key comes from the position in the scan, so the input has to be a
    stored table (or a checkpoint): reading it again, in another branch of the
    plan or after the loss of an executor, gives every row the same key.
    """
    return df.select(F.monotonically_increasing_id().alias(ROW_KEY), *columns)


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


BatchFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
