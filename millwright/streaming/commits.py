"""Micro-batches with several outputs, all or nothing (SRC-12, ST-8).

Every output of a micro-batch is a folder of its own; a marker is written after
the last one.  Readers take marked batches only, so a batch that is cut off between
its writes shows nothing.  Its replay writes every output anew and then the
marker; a batch that has its marker is not written again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .jobs import write_batch

MARKERS = "commits"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def committed_writer(root: str, outputs: Callable[[DataFrame], dict[str, DataFrame]]):
    """foreachBatch: writes ``{name: rows}`` of each micro-batch below ``root``, then its marker."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _exists(spark, f"{root}/{MARKERS}/batch_id={batch_id}"):
            return
        held = batch.persist()
        try:
            parts = outputs(held)
            for name, rows in parts.items():
                write_batch(rows, f"{root}/{name}", batch_id)
            write_batch(spark.createDataFrame([(sorted(parts),)], "outputs array<string>"), f"{root}/{MARKERS}", batch_id)
        finally:
            held.unpersist()
    return write


def read_committed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of one output, of marked micro-batches only."""
    marked = spark.read.parquet(f"{root}/{MARKERS}").where(F.array_contains("outputs", name)).select("batch_id")
    return spark.read.parquet(f"{root}/{name}").join(marked, "batch_id", "left_semi").drop("batch_id")
