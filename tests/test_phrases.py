"""Phrase tables against ``in``."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.signals import keyword_topics
from ledgerlens.functions.wordlists import KEYWORD_TOPICS
from ledgerlens.operators import phrases


def texts():
    rng = random.Random(6)
    rows = [(i, "".join(rng.choices("ab cé\U0001f600", k=rng.randint(0, 80)))) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "ABAB É"), (103, "ab" * 20_000), (0, "abc abc"), (None, "a b")]


def table():
    rng = random.Random(7)
    rows = [(rng.choice("xyz"), "".join(rng.choices("ab cé\U0001f600", k=rng.randint(1, 4)))) for _ in range(120)]
    return rows + [("x", ""), ("y", ""), ("x", "a"), ("y", "a"), ("x", "a"), (None, "a"), ("x", None), ("z", "nowhere")]


def expected():
    pairs = {(c, p) for c, p in table() if c is not None and p is not None}
    want = Counter()
    for k, t in texts():
        for c, p in pairs:
            if t is not None and p in t.lower():
                want[k, c] += 1
    return dict(want)


@pytest.mark.parametrize("slice_bytes", [20, 300, phrases.SLICE_BYTES])
def test_hits_equal_brute_force(spark, slice_bytes):
    df = spark.createDataFrame(texts(), "k long, t string").withColumns({"category": F.lit("clash"), "key": F.lit(1)}).repartition(4)
    found = phrases.phrase_hits(df, "k", "t", spark.createDataFrame(table(), "category string, phrase string"), slice_bytes)
    rows = found.collect()
    assert {(r["k"], r["category"]): r["hits"] for r in rows} == expected() and len(rows) == len(expected())


def test_a_hundred_thousand_phrases(spark):
    many = spark.range(100_000).select((F.col("id") % 3).cast("string").alias("category"), F.concat(F.lit("no "), F.col("id") * 7919 % 1_000_003, F.lit(";")).alias("phrase"))
    df = spark.range(200).select("id", F.concat_ws(" ", *[F.concat(F.lit("no "), (F.col("id") * 31 + j) * 7919 % 1_000_003, F.lit(";")) for j in range(30)]).alias("t"))
    found = {(r["id"], r["category"]): r["hits"] for r in phrases.phrase_hits(df, "id", "t", many).collect()}
    assert found == {(i, str(c)): 10 for i in range(200) for c in range(3)}


def test_topics_follow_the_built_in_rule(spark):
    words = [w for listed in KEYWORD_TOPICS.values() for w in listed]
    rng = random.Random(8)
    df = spark.createDataFrame([(i, " ".join(rng.choices(words, k=i % 9))) for i in range(80)], "k int, t string")
    own = spark.createDataFrame([(str(n), w) for n, listed in enumerate(KEYWORD_TOPICS.values()) for w in listed], "category string, phrase string")
    got = {(r["k"], int(r["category"])): (r["hits"], round(r["relevance"], 9)) for r in phrases.phrase_topics(df, "k", "t", own).collect()}
    tags = df.select("k", F.inline(keyword_topics("t"))).collect()
    assert got == {(r["k"], r["topic_id"]): (r["hits"], round(r["relevance"], 9)) for r in tags} and got


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], "category string, phrase string")
    df = spark.createDataFrame([(1, "a")], "k int, t string")
    assert phrases.phrase_hits(df, "k", "t", none).count() == 0
    assert phrases.phrase_hits(df.limit(0), "k", "t", none).count() == 0
