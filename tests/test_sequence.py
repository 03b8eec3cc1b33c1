"""Chunked (bounded) windows must equal plain whole-group windows exactly."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import ts
from millwright.operators import sequence as seq


def _data(spark, n=400):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        key = "HOT" if i % 3 else f"K{i % 5}"  # one key holds two thirds of the rows
        rows.append((i, key, "S1" if i % 2 else None, ts(minutes=rnd.randint(0, 300)),
                     None if i % 11 == 0 else float(rnd.randint(0, 9))))
    return spark.createDataFrame(rows, "id long, k string, s string, timestamp timestamp, v double")


def test_sequence_index_is_a_dense_rank(spark):
    df = _data(spark)
    got = seq.restore_keys(seq.sequence_index(df, ["k", "s"], ["timestamp", "id"], bucket_seconds=600), ["k", "s"])
    want = df.withColumn("_want", F.row_number().over(
        Window.partitionBy("k", "s").orderBy("timestamp", "id")) - 1)
    j = got.join(want, "id")
    assert j.where(F.col("_seq") != F.col("_want")).count() == 0
    assert j.count() == df.count()


def test_chunked_windows_equal_plain_windows(spark):
    df = _data(spark)
    keys = ["k", "s"]
    ch = seq.chunked(df, keys, ["timestamp", "id"], before=4, after=3, chunk_rows=5, bucket_seconds=900)
    w = seq.chunk_window(keys)
    got = seq.finish(ch.withColumns({
        "lag1": F.lag("v", 1).over(w), "lead3": F.lead("v", 3).over(w),
        "avg4": F.avg("v").over(w.rowsBetween(-4, -1))}), keys)
    pw = Window.partitionBy(*keys).orderBy("timestamp", "id")
    want = df.withColumns({"lag1_w": F.lag("v", 1).over(pw), "lead3_w": F.lead("v", 3).over(pw),
                           "avg4_w": F.avg("v").over(pw.rowsBetween(-4, -1))})
    j = got.join(want.select("id", "lag1_w", "lead3_w", "avg4_w"), "id")
    assert j.count() == df.count()
    for a, b in [("lag1", "lag1_w"), ("lead3", "lead3_w"), ("avg4", "avg4_w")]:
        assert j.where(~F.col(a).eqNullSafe(F.col(b))).count() == 0, a


def test_fill_forward_equals_last_ignore_nulls(spark):
    df = _data(spark)
    got = seq.restore_keys(seq.fill_forward(df, ["k"], ["timestamp", "id"], F.col("v"), "ff", chunk_rows=7,
                                            bucket_seconds=1200), ["k"])
    pw = Window.partitionBy("k").orderBy("timestamp", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("ff_w", F.last("v", ignorenulls=True).over(pw))
    j = got.join(want.select("id", "ff_w"), "id")
    assert j.count() == df.count()
    assert j.where(~F.col("ff").eqNullSafe(F.col("ff_w"))).count() == 0


def test_both_split_modes_give_the_same_index(spark):
    import pytest as _pt  # noqa: F401

    df = _data(spark)
    for split in ("range", "bucket"):
        got = seq.restore_keys(seq.sequence_index(df, ["k", "s"], ["timestamp", "id"], bucket_seconds=600,
                                                  split=split), ["k", "s"])
        want = df.withColumn("_want", F.row_number().over(
            Window.partitionBy("k", "s").orderBy("timestamp", "id")) - 1)
        j = got.join(want, "id")
        assert j.count() == df.count()
        assert j.where(F.col("_seq") != F.col("_want")).count() == 0, split


def test_range_split_cuts_a_hot_instant(spark):
    # 300 copies at one timestamp for one key: the range split (id in the key) still ranks them exactly
    rows = [(i, "HOT", "S", ts(0), float(i)) for i in range(300)] + [(1000 + i, "K", "S", ts(i), 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, k string, s string, timestamp timestamp, v double")
    got = seq.restore_keys(seq.sequence_index(df, ["k"], ["timestamp", "id"], split="range"), ["k"])
    hot = {r["id"]: r["_seq"] for r in got.where("k = 'HOT'").collect()}
    assert hot == {i: i for i in range(300)}


def test_split_mode_from_session_conf(spark):
    df = _data(spark, 60)
    spark.conf.set("millwright.sequence.split", "bucket")
    try:
        got = seq.restore_keys(seq.sequence_index(df, ["k"], ["timestamp", "id"]), ["k"])
        want = df.withColumn("_want", F.row_number().over(Window.partitionBy("k").orderBy("timestamp", "id")) - 1)
        assert got.join(want, "id").where(F.col("_seq") != F.col("_want")).count() == 0
    finally:
        spark.conf.unset("millwright.sequence.split")


def test_pieces_follow_the_rows_not_the_estimates(spark, monkeypatch):
    """Joins multiply the optimizer's estimates; the pieces stay the shuffle partitions until counted rows ask for more."""
    asked, plain = [], seq._split_column
    monkeypatch.setattr(seq, "_split_column", lambda *a: asked.append(a[5] or seq._pieces(a[0])) or plain(*a))
    df = _data(spark)
    other = df.select("id", F.col("v").alias("w"))
    joined = df.join(other, "id").join(other.withColumnRenamed("w", "x"), "id").join(other.withColumnRenamed("w", "y"), "id")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert seq.sequence_index(joined, ["k"], ["timestamp", "id"]).count() == 400 and asked == [n]
    # one key holds two thirds; pieces that came out too large are cut again
    monkeypatch.setattr(seq, "MAX_PIECE_ROWS", 60)
    monkeypatch.setattr(seq, "PIECE_ROWS", 20)
    got = seq.sequence_index(df, ["k"], ["timestamp", "id"])
    assert asked == [n, n, 20]
    want = df.withColumn("_want", F.row_number().over(Window.partitionBy("k").orderBy("timestamp", "id")) - 1)
    assert got.join(want.select("id", "_want"), "id").where("_seq <> _want").count() == 0
