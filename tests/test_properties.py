"""Property: bounded chunked windows equal plain windows for any chunk size and key skew."""
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from millwright.operators import sequence as seq

T0 = datetime(2026, 1, 1)

rows_st = st.lists(
    st.tuples(st.sampled_from(["A", "A", "A", "B", None]), st.integers(0, 500),
              st.one_of(st.none(), st.integers(0, 3).map(float))),
    min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, chunk=st.integers(3, 9), bucket=st.sampled_from([60, 600, 7200]))
def test_chunked_equals_plain(spark, rows, chunk, bucket):
    data = [(i, k, T0 + timedelta(minutes=m), v) for i, (k, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k string, timestamp timestamp, v double")
    ch = seq.chunked(df, ["k"], ["timestamp", "id"], before=3, after=2, chunk_rows=chunk, bucket_seconds=bucket)
    w = seq.chunk_window(["k"])
    got = seq.finish(ch.withColumns({"a": F.avg("v").over(w.rowsBetween(-3, -1)),
                                     "l": F.lead("v", 2).over(w)}), ["k"])
    pw = Window.partitionBy("k").orderBy("timestamp", "id")
    want = df.select("id", F.avg("v").over(pw.rowsBetween(-3, -1)).alias("a_w"), F.lead("v", 2).over(pw).alias("l_w"))
    g = {r["id"]: (r["a"], r["l"]) for r in got.collect()}
    wv = {r["id"]: (r["a_w"], r["l_w"]) for r in want.collect()}
    assert g.keys() == wv.keys()
    for i in g:
        for x, y in zip(g[i], wv[i]):
            assert (x is None and y is None) or abs(x - y) < 1e-9
