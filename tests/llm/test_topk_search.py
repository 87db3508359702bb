import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import topk_search as T

SCHEMA = "vec_id bigint, embedding array<float>, label int, vector string, ids string"


def brute(rows, k, every):
    import numpy as np

    good = {}
    for i, x, *_ in rows:
        if i is not None and x and all(v is not None and math.isfinite(v) for v in x):
            good[i, tuple(math.floor(64 * float(np.float32(v))) for v in x)] = None
    out = []
    for q, a in good:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def table(seed, n, scale=1.0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, scale) for _ in range(8)], 1, "x", "y") for i in range(n)]
    rows += [(n + i, rows[3][1], 1, "x", "y") for i in range(60)]  # many copies
    rows += [(1000, None, 1, "x", "y"), (1001, [1.0, None], 1, "x", "y"), (1002, [float("nan")] * 8, 1, "x", "y"), (1003, [], 1, "x", "y")]
    rows += [(1004, [math.inf] * 8, 1, "x", "y"), (None, [0.1] * 8, 1, "x", "y"), (1010, [0.5, 0.5], 1, "x", "y"), (1011, [0.5, 0.25], 1, "x", "y")]
    return rows + [rows[10]]


@pytest.mark.parametrize("k,batch,scale", [(5, 2048, 1.0), (7, 16, 1.0), (3, 16, 1e7), (400, 64, 1.0)])
def test_equals_brute_force(spark, monkeypatch, k, batch, scale):
    monkeypatch.setattr(T, "BATCH_ROWS", batch)
    monkeypatch.setattr(T, "PART_ROWS", 100)
    monkeypatch.setattr(T, "QUERY_BLOCK", 20)
    rows = table(7, 250, scale)
    found = T.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, k)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, k, 10)


def test_empty_table(spark):
    assert T.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_bounds_hold_and_most_exact_vectors_stay_unread(spark, bits):
    """The scan sees cells alone, its bounds hold the exact scores, and what it drops can't be among the best."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], 1, "x", "y") for i in range(600)]
    k = 5
    number = F.monotonically_increasing_id()
    whole = T.whole_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    vectors = T.stage(T.distinct_vectors(whole, k).withColumn("cand", number), "vectors")
    edges = T.cell_edges(vectors, bits)
    cells = T.approximations(vectors, edges)
    assert dict(cells.dtypes) == {"n": "int", "cand": "bigint", "first": "bigint", "cells": "binary"}
    assert all(len(r["cells"]) == 8 and max(r["cells"]) < 2**bits for r in cells.collect())
    queries = whole.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("q"), F.col("vec_id").alias("query_id"), "vector")
    exact = {r["vec_id"]: r["vector"] for r in whole.collect()}
    found = T.bounds(queries, cells, edges, k).collect()
    for r in found:
        assert r["lower"] <= sum(a * b for a, b in zip(exact[r["query_id"]], exact[r["first"]])) <= r["upper"]
    want = {(q, i) for q, _, i, _ in brute(rows, k, 20)}
    assert want <= {(r["query_id"], r["first"]) for r in found}
    if bits == 8:
        assert len(found) < 30 * 3 * k


@pytest.mark.parametrize("first_read", [1, 7, 1000])
def test_equal_scores_and_repeated_ids(spark, monkeypatch, first_read):
    """A query of zeros ties with all rows; an id with two vectors is a query for each; coarse cells and small first reads."""
    monkeypatch.setattr(T, "BATCH_ROWS", 16)
    monkeypatch.setattr(T, "PART_ROWS", 50)
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(-2, 3)) for _ in range(4)], 1, "x", "y") for i in range(200)]
    rows += [(300, [0.0] * 4, 1, "x", "y"), (20, [2.0] * 4, 1, "x", "y"), (301, [2.0] * 4, 1, "x", "y")]
    found = T.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, 6, bits=1, first_read=first_read)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 6, 10)
