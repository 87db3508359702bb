"""Scores of folds: all folds are fitted at the same time and scored in one pass."""

from threading import Barrier

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import models


class Rule:
    """Stands for an estimator and its model: predicts whether ``x`` is above the mean of the training rows."""

    def __init__(self, barrier, limit=None):
        self.barrier, self.limit = barrier, limit

    def copy(self):
        return self

    def fit(self, rows):
        self.barrier.wait(60)  # broken, if the folds are fitted one after another
        return Rule(self.barrier, rows.agg(F.avg("x")).first()[0])

    def transform(self, df):
        return df.withColumn("prediction", (F.col("x") > self.limit).cast("double")).withColumn("probability", F.lit(0.5))


def expected(rows, fold, side, limit):
    own = [(y, float(x > limit)) for x, y, f in rows if (f == fold) == (side == "test")]
    f1 = []
    for c in sorted({float(y) for y, _ in own} | {p for _, p in own}):
        hit = sum(y == c == p for y, p in own)
        wrong = sum((y == c) != (p == c) for y, p in own)
        f1.append(2 * hit / (2 * hit + wrong) if hit else 0.0)
    return sum(y == p for y, p in own) / len(own), sum(f1) / len(f1)


def test_folds_are_fitted_together_and_scored_in_one_pass(spark):
    rows = [(float(k * 7 % 31), int(k % 3 == 0), k % 3) for k in range(60)]
    df = spark.createDataFrame(rows, "x double, label int, fold int")
    scores = models.fold_scores(Rule(Barrier(3)), df, 3, "label", False).collect()
    found = {(r["side"], r["metric"], r["fold"]): r["value"] for r in scores}
    assert len(scores) == len(found) == 2 * 4 * 3
    for fold in range(3):
        train = [x for x, _, f in rows if f != fold]
        for side in ("test", "train"):
            accuracy, f1 = expected(rows, fold, side, sum(train) / len(train))
            assert found[side, "accuracy", fold] == pytest.approx(accuracy)
            assert found[side, "f1_macro", fold] == pytest.approx(f1)


def test_a_fold_without_rows_has_null_scores(spark):
    df = spark.createDataFrame([(1.0, 0.5, 0), (2.0, 2.5, 0), (4.0, 3.0, 1)], "x double, label double, fold int")
    scores = models.fold_scores(Rule(Barrier(3)), df, 3, "label", True).collect()
    found = {(r["side"], r["metric"], r["fold"]): r["value"] for r in scores}
    assert len(found) == 2 * 3 * 3 and found["test", "r2", 2] is None and found["train", "neg_mean_squared_error", 2] is not None
