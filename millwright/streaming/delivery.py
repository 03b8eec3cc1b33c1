"""Delivery with retries, a dead-letter table and counters (ST-9, ST-10, SRC-7).

A record that the contract or the store turns away is put into ``pending`` with
its number of attempts and the time before which it is not tried again.
``pending`` is the checkpointed source of a stream of its own, which tries
records that are due, puts the others back, and moves those that have used up
their attempts to ``dead``.  Accepted records are appended once, whichever of the two
streams brings them.  Each micro-batch of either stream writes a row of counters.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..session import cut_lineage
from ..sources import ingest as ig
from .jobs import run_available

PENDING = "raw_record string, attempts int, not_before timestamp, reject_reasons array<string>"
COUNTERS = "generated long, sent long, duplicate long, buffered long, retried long, failed long"


@dataclass(frozen=True)
class Delivery:
    """Where and how records are delivered.

    ``mend``: text of a record to try, from ``raw_record`` and ``attempts``;
    ``reachable``: whether the store takes a valid record, from its fields and ``attempts``
    (the attempts before this one); ``delay_seconds``: wait after the first failure, doubled after each further one.
    """

    root: str
    schema: T.StructType
    required: list[str]
    key: str = "event_id"
    max_attempts: int = 5
    delay_seconds: float = 60.0
    mend: Column | None = None
    reachable: Column | None = None

    def prepare(self, spark: SparkSession) -> None:
        """Empty tables, so that either stream can start first."""
        for name, schema in (("accepted", self.schema), ("pending", PENDING), ("dead", PENDING), ("counters", COUNTERS)):
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{self.root}/{name}/stream=none/batch_id=-1")

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{name}")

    def _tried(self, records: DataFrame) -> DataFrame:
        """Records classified by the contract and the store, with ``original`` and ``attempts``."""
        text = self.mend if self.mend is not None else F.col("raw_record")
        lines = records.select(text.alias("value"), F.col("raw_record").alias("original"), "attempts")
        rows = ig.classify_records(lines, self.schema, self.required, arrival=F.current_timestamp())
        if self.reachable is not None:
            away = F.col("is_valid") & ~F.coalesce(self.reachable, F.lit(False))
            rows = rows.withColumn("reject_reasons", F.when(away, F.array(F.lit("store_unreachable"))).otherwise(F.col("reject_reasons")))
            rows = rows.withColumn("is_valid", F.size("reject_reasons") == 0)
        return rows

    def writer(self, stream: str) -> Callable[[DataFrame, int], None]:
        """foreachBatch for rows of ``PENDING``: new records have no attempts."""
        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession

            def put(rows: DataFrame, name: str) -> int:
                path = f"{self.root}/{name}/stream={stream}/batch_id={batch_id}"
                rows.write.mode("overwrite").parquet(path)
                return spark.read.schema(rows.schema).parquet(path).count()  # from the files' footers

            # read once, classified once
            records = cut_lineage(batch.select("raw_record", "attempts", "not_before", "reject_reasons"))
            due = F.coalesce(F.col("not_before") <= F.current_timestamp(), F.lit(True))
            tried = cut_lineage(self._tried(records.where(due)))
            elsewhere = ~((F.col("stream") == stream) & (F.col("batch_id") == batch_id))
            stored = self.table(spark, "accepted").where(elsewhere).select(self.key)
            valid = tried.where("is_valid").select(*self.schema.fieldNames())
            sent = put(ig.idempotent_append(stored, valid, self.key), "accepted")
            wait = F.make_dt_interval(secs=F.lit(float(self.delay_seconds)) * F.pow(F.lit(2.0), F.col("attempts") - 1))
            bad = tried.where("not is_valid").select(F.col("original").alias("raw_record"), (F.col("attempts") + 1).alias("attempts"), "reject_reasons")
            bad = bad.select("raw_record", "attempts", (F.current_timestamp() + wait).alias("not_before"), "reject_reasons")
            over = F.col("attempts") >= self.max_attempts
            again = put(bad.where(~over).unionByName(records.where(~due)), "pending")
            dead = put(bad.where(over), "dead")
            n = tried.agg(F.count_if("is_valid").alias("valid"), F.count_if(F.col("attempts") == 0).alias("new"), F.count("*").alias("all")).first()
            waiting = records.where(~due).count()
            put(spark.createDataFrame([(n["new"], sent, n["valid"] - sent, again - waiting, n["all"] - n["new"], dead)], COUNTERS), "counters")
        return write

    def first_deliveries(self, lines: DataFrame, text_col: str = "value") -> DataFrame:
        """A stream of raw lines as records that have not been tried yet; blank lines are none."""
        return lines.where(F.trim(text_col) != "").select(
            F.col(text_col).alias("raw_record"), F.lit(0).alias("attempts"), F.lit(None).cast("timestamp").alias("not_before"),
            F.lit(None).cast("array<string>").alias("reject_reasons"))

    def retry_until_settled(self, spark: SparkSession, checkpoint: str, max_rounds: int = 100) -> int:
        """Runs the stream of pending records until nothing is pending; the number of rounds.

        A deployment leaves that stream running instead; each micro-batch is a round there.
        """
        schema = T.StructType.fromDDL(PENDING + ", stream string, batch_id int")
        for done in range(max_rounds):
            source = spark.readStream.schema(schema).parquet(f"{self.root}/pending")
            query = run_available(source.writeStream.foreachBatch(self.writer("retry")), checkpoint)
            if not sum(p["numInputRows"] for p in query.recentProgress):
                return done
            time.sleep(min(self.delay_seconds, 60.0))
        raise TimeoutError(f"records are still pending after {max_rounds} rounds")


class MetricRows(StreamingQueryListener):
    """Keeps the observed metrics of every micro-batch as rows and appends them to a table.

    Rows (query name, batch id, metric, value) are held until ``flush_rows`` have come or ``flush`` is called.
    """

    SCHEMA = "query string, batch_id long, name string, metric string, value string"

    def __init__(self, spark: SparkSession, path: str, flush_rows: int = 1_000):
        self.spark, self.path, self.flush_rows, self.rows = spark, path, flush_rows, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in (p.observedMetrics or {}).items():
            self.rows += [(p.name, p.batchId, name, k, None if v is None else str(v)) for k, v in row.asDict().items()]
        if len(self.rows) >= self.flush_rows:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
