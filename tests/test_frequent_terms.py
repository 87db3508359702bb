"""The exact most frequent terms against counters."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import vectorize


def lists():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [rng.choices(words, weights, k=rng.randint(0, 60)) + ["all"] for _ in range(300)]
    return rows + [None, [], [None, "w1"], ["w399"] * 500]


def best(most, max_df):
    rows = [[t for t in r or [] if t is not None] for r in lists()]
    cf, df = Counter(t for r in rows for t in r), Counter(t for r in rows for t in set(r))
    kept = [(t, cf[t], df[t]) for t in cf if df[t] <= max_df * len(rows)]
    return sorted(kept, key=lambda r: (-r[1], r[0]))[:most]


@pytest.mark.parametrize("buckets", [1, 16, 1 << 18])
@pytest.mark.parametrize("share", [0.0, 0.02, 1.0])
@pytest.mark.parametrize("most, max_df", [(1, 1.0), (30, 0.95), (30, 0.2), (1000, 0.95)])
def test_any_guess_gives_the_exact_terms(spark, buckets, share, most, max_df):
    df = spark.createDataFrame([(r,) for r in lists()], "terms array<string>").repartition(3)
    found = vectorize.frequent_terms(df, len(lists()), most, max_df, buckets, share)
    assert [tuple(r) for r in found.collect()] == best(most, max_df)


def test_no_terms(spark):
    none = spark.createDataFrame([], "terms array<string>")
    assert vectorize.frequent_terms(none, 0, 10, 0.95).count() == 0
    assert vectorize.frequent_terms(spark.createDataFrame([(["a"],)], "terms array<string>"), 1, 0, 1.0).count() == 0


def test_texts_are_counted_once(spark):
    """The terms are made at most twice, for the guess and for the counts; the last sums are made from written counts."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def terms(k):
        made.add(1)
        return [f"w{k % 7}", "all"]

    found = vectorize.frequent_terms(spark.range(200).select(terms("id").alias("terms")), 200, 3, 1.0)
    assert [tuple(r) for r in found.collect()] == [("all", 200, 200), ("w0", 29, 29), ("w1", 29, 29)]
    assert made.value <= 400


def test_the_guess_makes_no_terms_again(spark):
    """Likely terms are guessed from the written counts, so each text is made into terms once."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def terms(k):
        made.add(1)
        return [f"w{k % 7}", "all"]

    found = vectorize.frequent_terms(spark.range(200).select(terms("id").alias("terms")), 200, 3, 1.0, share=0.1)
    assert [tuple(r) for r in found.collect()] == [("all", 200, 200), ("w0", 29, 29), ("w1", 29, 29)]
    assert made.value == 200


def test_a_share_of_each_batch_is_counted_apart(spark):
    rows = [(["a", "b", "a"],), (["b"],), (None,), (["c", "a"],), ([],), (["c", None],), (["a"],)]
    df = spark.createDataFrame(rows, "terms array<string>").coalesce(1)
    found = vectorize.counted_terms(df, 1 / 3)
    assert {r["term"]: (r["cf"], r["df"], r["picked"]) for r in found.collect() if r["term"]} == {"a": (4, 3, 4), "b": (2, 2, 1), "c": (2, 2, 1)}
