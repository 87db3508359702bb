"""Queries on training data that have SQL give its rows, on the smallest data set."""

import duckdb
import pytest

from ledgerlens.llm import registered

NAMES = "documents embeddings pages benchmark labels conversations"


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_query_equals_sql(spark, data, name):
    connection = duckdb.connect()
    for one in NAMES.split():
        connection.execute(f"CREATE VIEW {one} AS SELECT * FROM read_parquet('{data}/{one}.parquet')")
    found = registered.QUERIES[name](spark, data)
    cursor = connection.execute(registered.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    want = cursor.fetchall()
    got = [tuple(r[c] for c in columns) for r in found.collect()]
    assert want and sorted(got, key=repr) == sorted(want, key=repr)
