import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import mixing as M

SCHEMA = "doc_id bigint, text string, source string, tokens int, rank string"
ROWS = (
    [(i, "one two three " * (1 + i % 5), "large", i, "x") for i in range(600)]
    + [(1000 + i, "a b", "middle", None, None) for i in range(120)]
    + [(2000 + i, "c d e f g", None, 1, "y") for i in range(30)]
    + [(3000, None, "empty", 1, "y"), (3001, " \n", "empty", 1, "y"), (None, "w " * 400, "long", 2, "z"), (5, "one two three", "large", 3, "z")]
)


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.mark.parametrize("limits", [{"most_repeats": 3.0}, {"most_repeats": None, "entropy": 1.1}, {"most_repeats": 2.5, "entropy": 0.9}, {"budget": 500.0}])
def test_weights_and_budget(docs, limits):
    totals = defaultdict(int)
    for _, text, source, *_ in ROWS:
        totals[source] += count(text)
    total = sum(totals.values())
    p = {s: t / total for s, t in totals.items() if t}

    def meets(a):
        z = sum(x**a for x in p.values())
        h = -sum(x**a / z * math.log(x**a / z) for x in p.values())
        repeats = (max(p.values()) / min(p.values())) ** (1 - a)
        limit = limits.get("most_repeats", 2.0)
        return (limits.get("entropy") is None or h <= limits["entropy"]) and (limit is None or repeats <= limit)

    mix = M.mixture(docs, **limits)
    assert mix.exponent == 1 or meets(mix.exponent + 1e-9)
    assert mix.exponent == 0 or not meets(mix.exponent - 1e-9)
    z = sum(x**mix.exponent for x in p.values())
    weight = {s: x**mix.exponent / z for s, x in p.items()}
    found = M.copies(docs, mix, block_tokens=1000).collect()
    taken, seen, order = defaultdict(int), defaultdict(set), defaultdict(list)
    for r in found:
        taken[r["source"]] += count(r["text"])
        seen[r["source"]].add(r["doc_id"])
        assert 0 <= r["_mix_place"] < 1 and r["_mix_weight"] == pytest.approx(weight.get(r["source"], 0))
    longest = {s: max(count(r[1]) for r in ROWS if r[2] == s) for s in totals}
    for s, w in weight.items():
        assert w * mix.budget - 2 * longest[s] <= taken[s] <= w * mix.budget + 1e-6
    if "budget" not in limits:  # every document appears, the source with the largest share once
        assert all(seen[s] == {r[0] for r in ROWS if r[2] == s} for s in totals)
        assert taken["large"] == totals["large"]


def test_blocks_hold_the_sources_in_their_weights(docs):
    mix = M.mixture(docs, most_repeats=2.0)
    rows = M.copies(docs, mix, block_tokens=mix.budget / 2).groupBy("_mix_block", "source").agg(F.sum(M.n_tokens("text")).alias("n")).collect()
    part = {(r["_mix_block"], r["source"]): r["n"] for r in rows}
    assert {b for b, _ in part} == {0, 1}
    for s in ("large", "middle"):
        assert part[0, s] == pytest.approx(part[1, s], rel=0.25)


def test_rows_keep_their_columns(docs):
    mixed = M.mixed_rows(docs)
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} == {r[0] for r in ROWS}


def test_tables_without_rows_or_tokens(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert M.mixed_rows(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "a", 1, "x"), (2, None, None, 1, "x")], SCHEMA)
    assert sorted(r["doc_id"] for r in M.mixed_rows(blank).collect()) == [1, 2]


def test_names_like_the_added_ones(spark, docs):
    """Columns called like those that the operator adds keep their values and, in the mixed rows, their names."""
    clash = docs.select("*", F.col("doc_id").alias("_mix_weight"), F.col("text").alias("_MIX_EPOCH"), F.col("source").alias("__mix_weight"), F.lit(1).alias("a.b"))
    rows = M.mixed_rows(clash)
    assert rows.columns == clash.columns
    plain = sorted(map(tuple, M.mixed_rows(docs).collect()), key=repr)
    assert sorted((tuple(r)[:5] for r in rows.collect()), key=repr) == plain
    for r in rows.collect():
        assert tuple(r)[5:] == (r["doc_id"], r["text"], r["source"], 1)
    again = M.copies(clash, M.mixture(clash))
    assert {"___mix_weight", "__MIX_EPOCH", "__mix_weight", "_mix_weight", "_mix_epoch"} <= set(again.columns)
