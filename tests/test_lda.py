"""Batch variational LDA: its bound, its independence of the partitioning, and several models in the same passes."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from ledgerlens.operators import lda, topics


@pytest.fixture(scope="module")
def documents(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(90):
        words = rng.choice(12, rng.integers(1, 60), p=np.r_[np.full(6, 0.15), np.full(6, 1 / 60)] if k % 2 else np.r_[np.full(6, 1 / 60), np.full(6, 0.15)])
        ids, counts = np.unique(words, return_counts=True)
        rows.append((k, Vectors.sparse(12, ids.tolist(), counts.astype(float).tolist())))
    rows.append((90, Vectors.sparse(12, [], [])))
    return spark.createDataFrame(rows, ["k", "v"]).cache()


def test_special_functions():
    digamma, log_gamma, _ = lda.inference()
    x = np.array([1e-3, 0.01, 0.5, 1.0, 1.25, 3.0, 10.0, 500.0])
    assert log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], abs=1e-9)
    step = 1e-5
    assert digamma(x[2:]) == pytest.approx([(math.lgamma(v + step) - math.lgamma(v - step)) / (2 * step) for v in x[2:]], abs=1e-6)
    assert digamma(x + 1) == pytest.approx(digamma(x) + 1 / x, abs=1e-9)


def test_bound_never_falls(documents):
    model = topics.fit_lda(documents, "v", 4, max_iter=40)
    assert len(model.bounds) > 3 and all(b >= a - 1e-6 * abs(a) for a, b in zip(model.bounds, model.bounds[1:]))


def test_two_topics_are_found(documents):
    model = topics.fit_lda(documents, "v", 2, max_iter=60)
    sides = {tuple(sorted(np.argsort(-w)[:6].tolist())) for w in model.weights}
    assert sides == {tuple(range(6)), tuple(range(6, 12))}


def test_partitioning_changes_nothing(documents):
    one = topics.fit_lda(documents.coalesce(1), "v", 3, max_iter=8)
    many = topics.fit_lda(documents.repartition(64, "k"), "v", 3, max_iter=8)
    assert many.weights == pytest.approx(one.weights, rel=1e-7) and many.bounds == pytest.approx(one.bounds, rel=1e-9)


def test_models_of_a_grid_are_those_of_single_fits(documents):
    grid = topics.fit_lda_grid(documents, "v", [2, 5], max_iter=10)
    for model, k in zip(grid, (2, 5)):
        single = topics.fit_lda(documents, "v", k, max_iter=10)
        assert model.weights == pytest.approx(single.weights, rel=1e-8) and model.bounds == pytest.approx(single.bounds)


def test_weights_of_a_document_solve_its_equations(documents, monkeypatch):
    monkeypatch.setattr(lda, "BLOCK_NUMBERS", 50)
    digamma, _, infer = lda.inference()
    rng = np.random.default_rng(1)
    expected, prior = rng.random((12, 3)), 0.5
    counts = [rng.integers(1, 9, n).astype(float) for n in (0, 1, 5, 12, 3)]
    columns = [rng.permutation(12)[: len(c)] for c in counts]
    starts = np.r_[0, np.cumsum([len(c) for c in counts])]
    for rows, gamma, *_ in infer(starts, np.concatenate(columns), np.concatenate(counts), expected, prior):
        for row, own in zip(rows, gamma):
            theta = np.exp(digamma(own) - digamma(own.sum()))
            again = prior + sum((c * theta * expected[t] / (theta @ expected[t]) for t, c in zip(columns[row], counts[row])), np.zeros(3))
            assert np.abs(again - own).mean() < lda.WEIGHT_TOLERANCE


def test_weights_sum_to_one_and_empty_documents_are_even(documents):
    model = topics.fit_lda(documents, "v", 3, max_iter=4)
    rows = {r["k"]: r["s"] for r in model.transform(documents).select("k", vector_to_array("topic_vector").alias("s")).collect()}
    assert all(sum(s) == pytest.approx(1.0) for s in rows.values()) and rows[90] == pytest.approx([1 / 3] * 3)


def test_tuning_is_one_search_over_all_counts(spark, documents):
    vocabulary = [f"w{i:02d}" for i in range(12)]
    found = topics.tune_topics(documents, "v", vocabulary, documents, topics.matrix_terms("v", vocabulary), [2, 4], n_words=5, max_iter=10)
    for r in found.collect():
        model = topics.fit_lda(documents, "v", r["topics"], 10)
        top = topics.top_words(topics.topic_word_weights(spark, model.topics_matrix(), vocabulary), 5)
        each = topics.umass_coherence(documents, topics.matrix_terms("v", vocabulary), top)
        assert r["mean_umass"] == pytest.approx(each.agg({"umass": "avg"}).first()[0])


def test_a_fit_goes_on_from_fewer_passes_to_the_same_model(documents):
    begun = topics.fit_lda(documents, "v", 3, max_iter=3)
    whole, rest = topics.fit_lda(documents, "v", 3, max_iter=7), topics.fit_lda(documents, "v", 3, max_iter=7, begun=begun)
    assert len(begun.bounds) == 3 and len(rest.bounds) == 7
    assert (rest.weights == whole.weights).all() and rest.bounds == whole.bounds
    ended = topics.fit_lda(documents, "v", 3, max_iter=200)
    again = topics.fit_lda(documents, "v", 3, max_iter=300, begun=ended)
    assert len(ended.bounds) < 200 and again.bounds == ended.bounds
