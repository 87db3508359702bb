"""Every registered query with SQL gives the rows of the SQL, on the smallest data set."""

import math

import duckdb
import pytest

from ledgerlens.queries import catalog

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for name in NAMES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def bag(rows, order):
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, data, name):
    df = catalog.QUERIES[name](spark, data)
    cursor = duck.execute(catalog.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    names = sorted(columns)
    got = bag(df.collect(), [df.columns.index(c) for c in names])
    want = bag(cursor.fetchall(), [columns.index(c) for c in names])
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b, abs=2e-5) if all(isinstance(x, float) for x in a) else _same(a, b)


def _same(a, b):
    return all(
        x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-5) for x, y in zip(a, b)
    )
