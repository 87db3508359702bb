import math
import random
import statistics

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerlens.operators import evaluate, lexicon, models, ordered, profile, split, versions
from ledgerlens.functions import sentiment
from ledgerlens.session import compact, small, spread, stage
from tests.conftest import values


def numbers(spark, items, name="v"):
    return spark.createDataFrame([(float(i),) for i in items], f"{name} double").repartition(5)


@pytest.mark.parametrize("limit", [5, 50, 100_000])
def test_exact_quantiles(spark, limit):
    rng = random.Random(1)
    items = [rng.gauss(0, 1) for _ in range(3000)] + [7.0] * 1500 + [1e9, -1e9]
    found = ordered.exact_quantiles(numbers(spark, items), "v", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0], limit)
    items.sort()
    for p, x in zip([0.0, 0.1, 0.25, 0.5, 0.9, 1.0], found):
        at = p * (len(items) - 1)
        low, high = items[math.floor(at)], items[math.ceil(at)]
        assert x == pytest.approx(low + (high - low) * (at - math.floor(at)), abs=1e-12)


def test_quantiles_of_nothing_and_of_one_value(spark):
    assert ordered.exact_quantiles(numbers(spark, []), "v", [0.5]) == [None]
    assert ordered.exact_quantiles(numbers(spark, [3, 3, 3]), "v", [0.5]) == [3.0]


@pytest.mark.parametrize("edges", [1, 3, 50])
def test_running_total(spark, edges):
    rows = [(float(x), (x * 7) % 5) for x in range(200)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "x double, n long").repartition(6)
    got = dict(values(ordered.add_running_total(df, "x", "n", "below", edges).select("x", "below")))
    total = 0
    for x, n in sorted(rows):
        assert got[x] == total
        total += n


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_with_one_hot_score(spark):
    rng = random.Random(3)
    rows = [(0.5, rng.randint(0, 1)) for _ in range(150)] + [(rng.random(), rng.randint(0, 1)) for _ in range(250)]
    df = spark.createDataFrame(rows, "s double, y int").repartition(7)
    assert evaluate.roc_auc(df, "s", "y").first()["roc_auc"] == pytest.approx(brute_auc(rows))
    assert evaluate.roc_auc(df.where("y = 1"), "s", "y").first()["roc_auc"] is None


def labelled(spark, n, share=0.25, parts=5):
    return spark.range(n).select(F.col("id"), (F.col("id") % 100 < share * 100).cast("int").alias("label")).repartition(parts)


def test_split_sizes_match_the_recorded_run(spark):
    done = split.stratified_split(labelled(spark, 12_500), "id", "label", 0.15000000000000005, 0.15)
    assert dict(values(done.groupBy("split").count())) == {"train": 9030, "val": 1594, "test": 1876}


def test_split_is_exact_per_class_and_stable(spark):
    one = split.stratified_split(labelled(spark, 1000, 0.3, 1), "id")
    many = split.stratified_split(labelled(spark, 1000, 0.3, 11), "id")
    assert sorted(values(one.select("id", "split"))) == sorted(values(many.select("id", "split")))
    counts = {(r["split"], r["label"]): r["count"] for r in one.groupBy("split", "label").count().collect()}
    assert counts == {
        ("test", 0): 140, ("test", 1): 60, ("val", 0): 84, ("val", 1): 36, ("train", 0): 476, ("train", 1): 204,
    }
    other = split.stratified_split(labelled(spark, 1000, 0.3), "id", seed=7)
    assert sorted(values(other.select("id", "split"))) != sorted(values(one.select("id", "split")))


def test_split_against_full_sort(spark):
    import hashlib

    done = dict(values(split.stratified_split(labelled(spark, 300, 0.4), "id").select("id", "split")))
    for label in (0, 1):
        ids = [i for i in range(300) if int(i % 100 < 40) == label]
        ids.sort(key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
        order = [done[i] for i in ids]
        assert order == sorted(order, key=["test", "val", "train"].index)


def test_split_without_validation_part_and_many_classes(spark):
    done = split.stratified_split(labelled(spark, 200), "id", test_size=0.2, val_size=0.0)
    assert dict(values(done.groupBy("split").count())) == {"train": 160, "test": 40}
    classes = spark.range(500).withColumn("label", F.col("id") % 37)
    counts = dict(values(split.stratified_split(classes, "id").groupBy("split").count()))
    assert counts == {"test": 100, "val": 60, "train": 340}


def test_folds(spark):
    done = split.folds(labelled(spark, 503), "id", "label", 5)
    sizes = {(r["label"], r["fold"]): r["count"] for r in done.groupBy("label", "fold").count().collect()}
    assert sum(sizes.values()) == 503 and len(sizes) == 10
    for label in (0, 1):
        per = [n for (l, _), n in sizes.items() if l == label]
        assert max(per) - min(per) <= 1


def test_sample(spark):
    df = labelled(spark, 1000)
    ids = sorted(r["id"] for r in split.exact_sample(df, "id", 137).collect())
    assert len(ids) == 137
    assert ids == sorted(r["id"] for r in split.exact_sample(df.repartition(3), "id", 137).collect())
    assert split.exact_sample(df, "id", 5000).count() == 1000
    assert split.exact_sample(df, "id", 0).count() == 0


def test_label(spark):
    df = spark.createDataFrame([(0.05,), (0.0501,), (None,)], "BHAR0_2 double")
    assert [r["label"] for r in split.add_label(df).collect()] == [0, 1, 0]
    assert split.add_label(df.withColumnRenamed("BHAR0_2", "other")).columns == ["other"]


def test_text_statistics(spark):
    texts = ["a b c", "", None, "a b c d e"]
    row = profile.text_statistics(spark.createDataFrame([(t,) for t in texts], "t string"), "t").first()
    lengths = [3, 0, 0, 5]
    assert row["mean_length"] == statistics.mean(lengths)
    assert row["median_length"] == statistics.median(lengths)
    assert row["std_length"] == pytest.approx(statistics.stdev(lengths))
    assert (row["total_documents"], row["empty_documents"]) == (4, 2)


def test_histogram_edges(spark):
    rows = values(profile.histograms(numbers(spark, [0, 1, 2, 3, 4]), {"v": F.col("v")}, 4).orderBy("bin"))
    assert [r[4] for r in rows] == [1, 1, 1, 2]
    same = values(profile.histograms(numbers(spark, [2, 2]), {"v": F.col("v")}, 3).orderBy("bin"))
    assert [r[4] for r in same] == [2, 0, 0]


def test_fingerprint_ignores_order_but_not_content(spark):
    rows = [(1, "a"), (2, None), (2, None), (3, "")]
    version = versions.content_version(spark.createDataFrame(rows, "i int, t string"))
    assert versions.content_version(spark.createDataFrame(rows[::-1], "i int, t string").repartition(3)) == version
    assert versions.content_version(spark.createDataFrame(rows[1:], "i int, t string")) != version
    shifted = [versions.content_version(spark.createDataFrame([r], "a string, b string")) for r in (("a|b", "c"), ("a", "b|c"), ("1:a", None), (None, "1:a"), ("", "-"))]
    assert len(set(shifted)) == 5 and len(version) == 10


def test_missing_numbers_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0.5), (2, nan), (3, None), (4, 0.01), (5, -inf), (6, inf)]
    df = spark.createDataFrame(rows, "i int, x double")
    labels = {r["i"]: r["label"] for r in split.add_label(df, "x").collect()}
    assert labels == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1}
    finite = df.where("i in (1, 2, 3, 4)")
    found = profile.describe(finite, "x").first()
    assert (found["count"], found["min"], found["q50"], found["max"]) == (2, 0.01, 0.255, 0.5)
    assert profile.box_statistics(finite, "x").first()["outliers"] == 0
    assert sum(r["n"] for r in profile.histograms(finite, {"x": F.col("x")}, 4).collect()) == 2


def test_lexicon_forms_agree(spark):
    texts = [(1, "risk of loss and growth growth"), (2, ""), (3, "Nothing here"), (4, "uncertain risk")] + [
        (i, "growth " * 50) for i in range(5, 9)
    ]
    df = spark.createDataFrame(texts, "k int, t string")
    direct = df.select("k", sentiment.lexicon_scores("t").alias("s")).select("k", "s.*")
    joined = lexicon.score_with_lexicon_table(df, "k", "t", lexicon.lexicon_table(spark))
    assert sorted(values(direct)) == sorted(values(joined))


def test_custom_analyzer_runs_in_sql(spark):
    lexicon.custom_analyzer("shout", lambda t: {"caps": float(sum(c.isupper() for c in t))}, ["caps"], spark)
    spark.createDataFrame([("ABc",), (None,)], "t string").createOrReplaceTempView("shouts")
    assert values(spark.sql("SELECT shout(t).caps FROM shouts")) == [(2.0,), (None,)]


def test_classification_report_with_a_class_that_is_never_predicted(spark):
    rows = [(0, 0)] * 5 + [(1, 0)] * 3 + [(0, 2)]
    df = spark.createDataFrame(rows, "y int, p int")
    report = {r["name"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert (report["1"]["precision"], report["1"]["recall"], report["1"]["support"]) == (0.0, 0.0, 3)
    assert (report["2"]["recall"], report["2"]["support"]) == (0.0, 0)
    assert report["accuracy"]["f1"] == pytest.approx(5 / 9)
    assert report["macro avg"]["recall"] == pytest.approx((5 / 6) / 3)


def test_fold_summary(spark):
    rows = [("neg_mse", 0, -1.0), ("neg_mse", 1, -3.0), ("r2", 0, 0.5), ("r2", 1, 0.7)]
    df = spark.createDataFrame(rows, "metric string, fold int, value double")
    got = {r["metric"]: (r["mean"], r["std"], r["values"]) for r in evaluate.summarise_folds(df).collect()}
    assert got["mse"] == (2.0, 1.0, [1.0, 3.0])
    assert got["neg_mse"] == (-2.0, 1.0, [-1.0, -3.0])


def test_importance_tables(spark):
    table = models.coefficient_table(spark, [0.5, -2.0, 0.0], ["a", "b", "c"])
    assert [r["feature"] for r in models.top_features(table, 2).collect()] == ["b", "a"]
    assert [r["feature"] for r in models.top_features_signed(table, 2).collect()] == ["b", "a"]
    assert [r["feature"] for r in models.nonzero_coefficients(table).collect()] == ["a", "b"]
    assert models.coefficient_table(spark, [1.0], ["a", "b"]).first()["feature"] == "Feature 0"
    groups = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "zzz")], "group string, feature string")
    assert values(models.group_importance(table, groups)) == [("g", 2.5), ("h", 0.0)]


def test_session_helpers(spark):
    df = spark.range(100)
    assert values(small(df)) == values(df)
    assert small(df, 10) is df
    staged = stage(df.withColumn("x", F.col("id") * 2))
    assert staged.count() == 100 and "Range" not in staged._jdf.queryExecution().toString()
    assert spread(df.coalesce(1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert compact(df.repartition(6)).rdd.getNumPartitions() == 1


def test_rows_without_label_are_split_too(spark):
    df = labelled(spark, 400).withColumn("label", F.when(F.col("id") % 4 == 0, None).otherwise(F.col("label")))
    done = split.stratified_split(df, "id")
    assert dict(values(done.groupBy("split").count())) == {"test": 80, "val": 48, "train": 272}
    assert done.where("split = 'test' and label is null").count() == 20
    plain = split.random_split(df.drop("label"), "id")
    assert plain.columns == ["id", "split"]
    assert dict(values(plain.groupBy("split").count())) == {"test": 80, "val": 48, "train": 272}


def test_split_by_shuffle_join_gives_the_same_rows(spark, monkeypatch):
    df = spark.range(300).withColumn("label", F.col("id") % 7)
    broadcast = sorted(values(split.stratified_split(df, "id").select("id", "split")))
    monkeypatch.setattr(split, "small", lambda table: table)
    assert sorted(values(split.stratified_split(df, "id").select("id", "split"))) == broadcast


def test_lasso_on_moments_equals_fits_per_fold(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        x = [rng.gauss(0, s) for s in (1, 5, 0.2)] + [3.0]
        rows.append((i, i % 3, x, 2 * x[0] - 0.3 * x[1] + rng.gauss(0, 0.5) + 7))
    df = spark.createDataFrame(rows, "key int, fold int, x array<double>, y double")
    folded = df.select("key", "fold", array_to_vector("x").alias("features"), "y").repartition(5)
    moments = models.fold_moments(folded, 3, "y")
    for alpha in (0.001, 0.1, 1.5):
        fitted = models.lasso(alpha, label="y").fit(folded)
        b, intercept = models.lasso_on_moments(moments.sum(axis=0), alpha)
        assert list(b) == pytest.approx(list(fitted.coefficients), abs=1e-5)
        assert intercept == pytest.approx(fitted.intercept, abs=1e-4)
        wanted = models.mean_fold_score(models.lasso(alpha, label="y"), folded, 3, "y", True)
        assert models.lasso_fold_score(moments, alpha) == pytest.approx(wanted, abs=1e-5)
