"""The registered SQL gives the queries' rows, and every operator has its query."""

import re

import duckdb
import pytest

from millwright.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()]
    assert sorted(numbers) == list(range(1, 14)) and set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    got = queries.queries()[name](spark, SF).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(res.fetchall())
