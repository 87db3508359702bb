"""Exact top-k inner products by a vector-approximation file (operator 8, NumPy tasks and joins).

Vectors become whole numbers, floor(64 x). Every dimension is cut into equal cells, and the cell numbers of a vector, one
byte each, are its approximation. They are written as a table of their own, the vector-approximation file. Equal vectors are
one candidate with their k + 1 smallest ids, which is all that ties can ever return.

1. Scan. Only the approximations are read, by one task for each block of queries and part of the candidates. The cells give
   a lower and an upper bound of each score. A candidate stays while fewer than k others have a lower bound above its upper
   one (equal bounds: and a smaller id). What the parts keep is compared once more over all parts.
2. Exact vectors are fetched by number in the order of the upper bounds: the ``first_read`` candidates of each query, then
   those of the rest whose upper bound still reaches the k-th best exact score. No other exact vector is read.

A task holds one block of queries with what they keep, and one batch of approximations; a part may be of any size.

Cases: vectors that are null, empty or hold a null, NaN or infinite component take no part. Vectors of different lengths are
not compared. Rows with the id of the query are the query's own; different vectors under one id are a query each. Repeated
rows are one. An empty table gives no rows. Scores are exact while they fit into 63 bits; where they pass 52 bits the bounds
are widened by more than the rounding of their sums. Further columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import stage

K, CELL_BITS = 20, 6
QUERY_BLOCK, PART_ROWS, BATCH_ROWS = 16_384, 8192, 2048
TASKS_A_CORE = 4  # parts are no smaller than that many tasks for each core need
EXACT_FLOATS = 2**52


def whole_vectors(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, vector (floor of 64 x) of the rows that take part."""
    x = F.col("x")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size("x") > 0) & F.coalesce(finite, F.lit(False)))
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * 64).cast("bigint")).alias("vector"))


def distinct_vectors(whole: DataFrame, k: int) -> DataFrame:
    """vector, ids: the k + 1 smallest ids of each vector. The rank is limited before the shuffle, so a vector may be hot."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    ranked = whole.distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    return ranked.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def cell_edges(vectors: DataFrame, bits: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each vector length the least value and the cell width of every dimension: two numbers for each dimension."""
    each = vectors.select(F.size("vector").alias("n"), F.posexplode("vector").alias("i", "v"))
    rows = each.groupBy("n", "i").agg(F.min("v").alias("low"), F.max("v").alias("high")).collect()
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for n in {r["n"] for r in rows}:
        own = sorted((r for r in rows if r["n"] == n), key=lambda r: r["i"])
        low = np.array([r["low"] for r in own], np.int64)
        span = np.array([r["high"] - r["low"] + 1 for r in own], np.int64)
        out[n] = low, -(-span // 2**bits)
    return out


def approximations(vectors: DataFrame, edges: dict) -> DataFrame:
    """n, cand, first (smallest id), cells (one byte for each of the n dimensions) of the candidates."""

    def work(batches):
        for batch in batches:
            cells = []
            for vector in batch.column(2).to_pylist():
                low, width = edges[len(vector)]
                cells.append(((np.array(vector, np.int64) - low) // width).astype(np.uint8).tobytes())
            sizes = pa.array([len(c) for c in cells], pa.int32())
            yield pa.RecordBatch.from_arrays([sizes, batch.column(0), batch.column(1), pa.array(cells, pa.binary())], ["n", "cand", "first", "cells"])

    named = vectors.select("cand", F.element_at("ids", 1).alias("first"), "vector")
    return named.mapInArrow(work, "n int, cand bigint, first bigint, cells binary")


def kept(own: int, cand: np.ndarray, first: np.ndarray, lower: np.ndarray, upper: np.ndarray, k: int):
    """The candidates that may be among the k best, and the k-th lower bound. The query's own rows prove nothing."""
    other = np.flatnonzero(first != own)
    if len(other) < k:
        return (cand, first, lower, upper), -np.inf
    if len(other) > 4 * k:  # the k-th bound needs no full order
        least = np.partition(lower[other], len(other) - k)[len(other) - k]
        other = other[lower[other] >= least]
    last = other[np.lexsort((first[other], -lower[other]))[k - 1]]
    stay = (upper > lower[last]) | ((upper == lower[last]) & (first <= first[last]))
    return (cand[stay], first[stay], lower[stay], upper[stay]), lower[last]


def scanned(pairs: DataFrame, edges: dict, k: int) -> DataFrame:
    """(q, query_id, cand, first, lower, upper): what each part keeps for each query. A pair's rows stand together, queries
    first; candidates come as cells only."""
    names = ["q", "query_id", "cand", "first", "lower", "upper"]
    kinds = [*[pa.int64()] * 4, *[pa.float64()] * 2]

    def work(batches):
        name, queries, state = None, [], []
        cut, plus, minus = np.zeros(0), None, None
        held: list[tuple] = []

        def scan():
            """The approximations that are held, for all queries of the pair."""
            nonlocal cut, plus, minus
            if not held or not queries:
                held.clear()
                return
            n = len(held[0][2])
            if plus is None:
                asked = np.array([q[2] for q in queries], np.int64)
                plus, minus = np.maximum(asked, 0).astype(float), np.minimum(asked, 0).astype(float)
                cut = np.full(len(queries), -np.inf)
            low, width = edges[n]
            cells = np.frombuffer(b"".join(h[2] for h in held), np.uint8).reshape(len(held), n).astype(np.int64)
            under = (low + cells * width).astype(float)
            over = under + (width - 1)
            cand, first = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
            most = max(np.abs(under).max(), np.abs(over).max()) * n
            for begin in range(0, len(queries), 256):
                p, m = plus[begin : begin + 256], minus[begin : begin + 256]
                upper, lower = p @ over.T + m @ under.T, p @ under.T + m @ over.T
                largest = float(max(p.max(initial=0), -m.min(initial=0))) * most
                if largest >= EXACT_FLOATS:
                    upper, lower = upper + largest * n * 2.0**-50, lower - largest * n * 2.0**-50
                near = upper >= cut[begin : begin + 256, None]
                for j in np.flatnonzero(near.any(axis=1)):
                    new = np.flatnonzero(near[j])
                    parts = [np.concatenate(x) for x in zip(state[begin + j], (cand[new], first[new], lower[j][new], upper[j][new]))]
                    state[begin + j], cut[begin + j] = kept(queries[begin + j][1], *parts, k)
            held.clear()

        def answers():
            sizes = [len(s[0]) for s in state]
            own = [np.repeat(np.array([q[i] for q in queries], np.int64), sizes) for i in (0, 1)]
            columns = [*own, *(np.concatenate([s[i] for s in state]) if state else np.zeros(0) for i in range(4))]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, kinds)], names)

        for batch in batches:
            for pair, number, ident, vector, cells in zip(*(c.to_pylist() for c in batch.columns)):
                if pair != name:
                    scan()
                    yield answers()
                    name, queries, state, plus = pair, [], [], None
                if cells is None:
                    queries.append((number, ident, vector))
                    state.append((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)))
                else:
                    held.append((number, ident, cells))
                    if len(held) >= BATCH_ROWS:
                        scan()
        scan()
        yield answers()

    return pairs.mapInArrow(work, "q bigint, query_id bigint, cand bigint, first bigint, lower double, upper double")


def bounds(queries: DataFrame, cells: DataFrame, edges: dict, k: int) -> DataFrame:
    """(q, query_id, cand, first, lower, upper, place): candidates that may be among the k best of a query, by upper bound."""
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    tasks = TASKS_A_CORE * queries.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-cells.count() // PART_ROWS), -(-tasks // blocks)))
    block, part = F.pmod(F.xxhash64("q"), F.lit(blocks)), F.pmod(F.xxhash64("cand"), F.lit(parts))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))
    asked = queries.select(
        F.size("vector").alias("n"), every(parts).alias("p"), block.alias("b"), F.col("q").alias("number"), F.col("query_id").alias("ident"),
        "vector", F.lit(None).cast("binary").alias("cells"),
    )
    given = cells.select(
        "n", part.alias("p"), every(blocks).alias("b"), F.col("cand").alias("number"), F.col("first").alias("ident"),
        F.lit(None).cast("array<bigint>").alias("vector"), "cells",
    )
    pairs = asked.unionByName(given).select(F.concat_ws(":", "n", "b", "p").alias("pair"), "number", "ident", "vector", "cells")
    dealt = pairs.repartition("pair").sortWithinPartitions("pair", F.col("cells").isNotNull(), "number")
    found = stage(scanned(dealt, edges, k), "bounds")
    # The same comparison over all parts.
    best = Window.partitionBy("q").orderBy(F.col("lower").desc(), "first", "cand")
    other = F.col("first") != F.col("query_id")
    ranked = found.withColumn("better", F.sum(other.cast("int")).over(best))
    last = F.min(F.when(other & (F.col("better") == k), F.struct("lower", "first"))).over(Window.partitionBy("q"))
    upper = F.col("upper")
    stay = F.col("last").isNull() | (upper > F.col("last.lower")) | ((upper == F.col("last.lower")) & (F.col("first") <= F.col("last.first")))
    order = Window.partitionBy("q").orderBy(upper.desc(), "first", "cand")
    return ranked.withColumn("last", last).filter(stay).select(*found.columns, F.row_number().over(order).alias("place"))


def exact(wanted: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """(q, query_id, score, vec_id): exact scores of the wanted candidates, one row for each of their ids but the query's own."""
    asked = queries.select("q", F.col("vector").alias("asked"))
    read = wanted.select("q", "query_id", "cand").join(vectors, "cand").join(asked, "q")
    product = F.aggregate(F.zip_with("asked", "vector", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda s, x: s + x)
    each = read.select("q", "query_id", product.alias("score"), F.explode("ids").alias("vec_id"))
    return each.filter("vec_id <> query_id")


def top_k(
    table: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", bits: int = CELL_BITS,
    first_read: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows with the highest scores for each row that ``is_query`` (a condition on
    vec_id) marks. ``bits`` (at most 8) give the cells of a dimension, ``first_read`` the exact vectors read at once (2 k)."""
    number = F.monotonically_increasing_id()
    whole = stage(whole_vectors(table, vec_id, embedding), "whole-vectors")
    vectors = stage(distinct_vectors(whole, k).withColumn("cand", number), "vectors")
    edges = cell_edges(vectors, bits)
    cells = stage(approximations(vectors, edges), "approximations")
    queries = stage(whole.filter(is_query).distinct().select(number.alias("q"), F.col("vec_id").alias("query_id"), "vector"), "queries")
    order = stage(bounds(queries, cells, edges, k), "order")
    at_once = first_read or 2 * k
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    near = stage(exact(order.filter(F.col("place") <= at_once), queries, vectors).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "near")
    certain = near.filter(F.col("rank") == k).select("q", F.col("score").alias("least"))
    far = order.filter(F.col("place") > at_once).join(certain, "q", "left").filter(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
    every = near.drop("rank").unionByName(exact(far, queries, vectors))
    return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
