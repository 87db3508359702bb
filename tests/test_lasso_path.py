"""The screened Lasso path against its optimality condition and against single solutions."""

import time

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerlens.operators import models


def sums(n, p, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 8))
    x = base @ rng.normal(size=(8, p)) * 0.5 + rng.normal(size=(n, p)) * rng.uniform(0, 3, p)
    x[:, 3] = 2.0
    y = x[:, :5] @ [1, -2, 0.5, 3, 0] + rng.normal(size=n) + 4
    rows = np.column_stack([np.ones(n), x, y])
    return x, y, rows.T @ rows


@pytest.mark.parametrize("n, p", [(500, 30), (80, 300), (3000, 900)])
def test_every_coefficient_is_optimal(n, p):
    x, y, total = sums(n, p)
    alphas = [0.3, 5.0, 0.05, 1.0, 0.3, 1e9]
    start = time.perf_counter()
    path = models.lasso_path(total, alphas, tolerance=1e-10)
    assert time.perf_counter() - start < 60
    for alpha, (b, intercept) in zip(alphas, path):
        gradient = (x - x.mean(0)).T @ (y - x @ b - intercept) / n
        used = b != 0
        assert gradient[used] == pytest.approx(alpha * np.sign(b[used]), abs=1e-6)
        assert (np.abs(gradient[~used]) <= alpha + 1e-6).all() and not used[3]
        assert (y - x @ b).mean() == pytest.approx(intercept, abs=1e-8)
    assert not path[-1][0].any() and (path[0][0] == path[4][0]).all()


def test_wide_search_makes_no_fit_per_fold(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector

    x, y, _ = sums(150, 250, 2)
    rows = [(i, x[i].tolist(), float(y[i])) for i in range(150)]
    df = spark.createDataFrame(rows, "k long, x array<double>, y double").select("k", array_to_vector("x").alias("features"), "y")
    monkeypatch.setattr(models, "mean_fold_score", None)
    found = models.train_lasso(df, "k", "y", alphas=4, alpha_range=(0.05, 2.0), k=3)
    assert found["search"].count() == 4 and found["coefficients"].count() == 250


def test_gradients_of_all_models_come_from_one_pass(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((40, 5)) * (rng.random((40, 5)) < 0.5)
    y = [None if k == 7 else float(v) for k, v in enumerate(rng.standard_normal(40))]
    vectors = [Vectors.dense(r) if k % 2 else Vectors.sparse(5, {i: float(v) for i, v in enumerate(r) if v}) for k, r in enumerate(x)]
    rows = spark.createDataFrame(list(zip(y, vectors)), StructType([StructField("y", DoubleType()), StructField("v", VectorUDT())])).repartition(3)
    fitted = [(rng.standard_normal(5), 0.5), (np.zeros(5), -1.0)]
    held = [k for k in range(40) if k != 7]
    right = np.array([y[k] for k in held])
    for (b, intercept), found in zip(fitted, models.lasso_gradients(rows, "y", "v", fitted)):
        assert found == pytest.approx(x[held].T @ (right - x[held] @ b - intercept) / 39)
    assert models.lasso_gradients(rows.where("y is null"), "y", "v", fitted) is None
