"""Lexicons larger than a broadcast, with terms that make up most of the tokens."""

from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerlens.functions.sentiment import SCORES
from ledgerlens.functions.wordlists import LEXICON
from ledgerlens.operators import lexicon
from ledgerlens.operators.hot_join import frequent_terms

NAMES = list(LEXICON)


@pytest.fixture(scope="module")
def table(spark):
    """100,000 terms of one category each, and the hot term in two."""
    name = F.get(F.array(*[F.lit(n) for n in NAMES]), (F.col("id") % 4).cast("int"))
    terms = spark.range(100_000).select(name.alias("category"), F.concat(F.lit("w"), "id").alias("term"))
    return terms.union(spark.createDataFrame([("positive", "the"), ("litigious", "the")], "category string, term string"))


def texts():
    rows = [(i, " ".join(["the"] * 20 + [f"w{(i * 20 + j) * 37 % 120_000}" for j in range(20)])) for i in range(400)]
    return rows + [(1000, None), (1001, ""), (1002, "the the"), (1003, "unknown words only"), (None, "w1 w1 the"), (1004, "w2 " * 3000)]


def expected(text):
    words = (text or "").split()
    n = Counter()
    for w in words:
        if w == "the":
            n.update(["positive", "litigious"])
        elif w[0] == "w" and w[1:].isdigit() and int(w[1:]) < 100_000:
            n[NAMES[int(w[1:]) % 4]] += 1
    base = max(len(words), 1)
    shares = [n[name] / base for name in SCORES[:4]]
    return (*shares, (n["positive"] - n["negative"]) / base, n["positive"] / (n["negative"] + 1))


@pytest.mark.parametrize("most", [1, 50])
def test_scores_equal_brute_force(spark, table, most):
    df = spark.createDataFrame(texts(), "k int, t string").withColumn("term", F.lit("clash")).repartition(6)
    want = {k: expected(t) for k, t in texts()}
    for got in (lexicon.score_with_lexicon_table(df, "k", "t", table, most=most), lexicon.score_with_lexicon_table(df, "k", "t", table, limit=200_000)):
        rows = {r["k"]: tuple(r[name] for name in SCORES) for r in got.collect()}
        assert rows.keys() == want.keys()
        assert all(rows[k] == pytest.approx(want[k]) for k in want)


def test_counts_equal_brute_force(spark, table):
    cells = [(k, w, n) for k, t in texts() if k is not None for w, n in Counter((t or "").split()).items()]
    counts = spark.createDataFrame([*cells, (1000, None, 0)], "k int, term string, tf long")
    want = {k: expected(t) for k, t in texts() if k is not None and (t or k == 1000)}
    rows = {r["k"]: tuple(r[n] for n in SCORES) for r in lexicon.scores_from_counts(counts, "k", table, most=5).collect()}
    assert rows.keys() == want.keys() and all(rows[k] == pytest.approx(want[k]) for k in want)


def test_no_task_holds_the_hot_term(spark):
    df = spark.createDataFrame([r for r in texts() if r[0] is not None and r[0] < 1000], "k int, t string").repartition(8)
    hot = frequent_terms(df.select(F.explode(F.split("t", " ")).alias("term")), "term", 5)
    assert "the" in hot
    rest = lexicon.rare_tokens(df, "k", "t", hot, {n: [] for n in NAMES})
    sizes = sorted(r["count"] for r in rest.repartition(16, "term").groupBy(F.spark_partition_id()).count().collect())
    assert rest.where("term = 'the'").count() == 0 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert rest.agg(F.sum("here.total")).first()[0] == 400 * 40


def test_no_texts(spark, table):
    assert lexicon.score_with_lexicon_table(spark.createDataFrame([], "k int, t string"), "k", "t", table).count() == 0


def test_matrix_rows_are_scored_in_batches(spark):
    """Sums of a count matrix, also of rows without cells, without a vector and with a dense one; no row is walked by an expression."""
    vectors = [Vectors.sparse(4, [0, 2, 3], [2.0, 1.0, 5.0]), Vectors.sparse(4, [], []), None, Vectors.dense([1.0, 0.0, 0.0, 0.0]), Vectors.sparse(4, [1], [3.0])]
    df = spark.createDataFrame(list(enumerate(vectors)), StructType([StructField("k", LongType()), StructField("v", VectorUDT())]))
    words = {"positive": ["a"], "negative": ["b", "c"], "uncertainty": ["c", "zz"], "litigious": []}
    found = lexicon.score_vectors(df.coalesce(1), "k", "v", ["a", "b", "c", "d"], words)
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
    rows = {r["k"]: tuple(r)[1:] for r in found.collect()}
    assert rows[0] == (2 / 8, 1 / 8, 1 / 8, 0.0, 1 / 8, 1.0)
    assert rows[1] == (0.0,) * 6 and rows[4] == (0.0, 1.0, 0.0, 0.0, -1.0, 0.0)
    assert rows[2] == rows[3] == (None,) * 6
