"""Exact order statistics of several columns against sorted lists."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import ordered, profile


def columns():
    rng = random.Random(4)
    n = 6000
    skewed = [7.0] * (n // 2) + [rng.gauss(0, 100) for _ in range(n // 2)]
    rng.shuffle(skewed)
    return {
        "plain": [rng.gauss(0, 1) for _ in range(n)],
        "skewed": skewed,
        "missing": [rng.choice([None, math.nan, float(i % 11)]) for i in range(n)],
        "far": [rng.choice([1.0, 2.0, 3.0, 1e12, -1e12]) if i % 50 == 0 else rng.random() for i in range(n)],
        "flat": [0.5] * n,
        "none": [None] * n,
        "steep": [math.exp(rng.random() * 200) for _ in range(n)],
    }


def brute(values, p):
    x = p * (len(values) - 1)
    a, b = values[math.floor(x)], values[math.ceil(x)]
    return a + (b - a) * (x - math.floor(x))


@pytest.fixture(scope="module")
def df(spark):
    data = columns()
    rows = list(zip(*data.values()))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(7)


@pytest.mark.parametrize("limit", [3, 40, 700, 100_000])
def test_profiles_equal_sorted_lists(df, limit):
    data = columns()
    found = ordered.profile_columns(df, {c: c for c in data}, max_candidates=limit, whiskers=True)
    assert list(found) == list(data)
    for name, items in data.items():
        values = sorted(v for v in items if v is not None and not math.isnan(v))
        got = found[name]
        assert got.count == len(values)
        if not values:
            assert got == ordered.ColumnProfile(quantiles=[None] * 3)
            continue
        q25, q50, q75 = want = [brute(values, p) for p in ordered.QUARTILES]
        assert got.quantiles == pytest.approx(want, rel=1e-12, abs=1e-12)
        low, high = got.quantiles[0] - 1.5 * (got.quantiles[2] - got.quantiles[0]), got.quantiles[2] + 1.5 * (got.quantiles[2] - got.quantiles[0])
        assert (got.low, got.high) == (values[0], values[-1])
        assert got.lower_whisker == min(v for v in values if v >= low) and got.upper_whisker == max(v for v in values if v <= high)
        assert got.outliers == sum(not low <= v <= high for v in values)
        assert got.mean == pytest.approx(math.fsum(values) / len(values), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("limit", [1000, 100_000])
def test_two_scans_for_any_number_of_columns(spark, df, limit):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    big = df.select(*[F.col(c).alias(c) for c in df.columns]).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(20))))
    big = big.withColumn("plain", F.col("plain") + F.col("k"))
    seen = big.mapInArrow(count, big.schema)
    ordered.profile_columns(seen, {c: c for c in big.columns}, max_candidates=limit, whiskers=True)
    assert read.value == 2 * 6000 * 20


def test_infinite_values_and_edges(spark):
    items = [math.inf, -math.inf, 1.0, 2.0, 3.0, math.inf]
    inf = spark.createDataFrame([(v,) for v in items], "v double")
    for limit in (2, 100):
        got = ordered.profile_columns(inf, {"v": "v"}, [0.0, 0.4, 1.0], max_candidates=limit)["v"]
        assert got.quantiles == [-math.inf, 2.0, math.inf]
    assert ordered.profile_columns(inf, {}, [0.5]) == {}
    assert ordered.profile_columns(inf.limit(0), {"v": "v"}, [])["v"].quantiles == []
    assert [r["count"] for r in profile.describe_columns(inf.limit(0), {"a": "v", "b": F.col("v") * 2}).collect()] == [0, 0]
    with pytest.raises(ValueError):
        ordered.profile_columns(inf, {"v": "v"}, [0.5], whiskers=True)
