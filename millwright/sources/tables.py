"""Generic table access (SRC-1..3): typed scans, top-N, parameterised SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Typed scan; a missing table yields an empty frame of ``schema``."""
    try:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)
    except Exception as exc:  # noqa: BLE001 - Spark raises AnalysisException for a missing path
        if schema is not None and "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def read_latest(df: DataFrame, order_by: str, n: int) -> DataFrame:
    """Top-N by ``order_by`` descending (planned as TakeOrderedAndProject)."""
    return df.orderBy(F.col(order_by).desc()).limit(n)


def read_query(spark: SparkSession, sql: str, views: dict[str, DataFrame], args: dict | None = None) -> DataFrame:
    """Parameterised SQL over registered temp views (named ``:param`` markers)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args or {})
