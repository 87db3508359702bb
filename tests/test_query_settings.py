"""Registered queries run their operators at the settings of the library."""

import inspect

import pytest

from ledgerlens.operators import features, models, topics, vectorize
from ledgerlens.plans import jobs
from ledgerlens.queries import catalog, model_queries, vector_queries

TOPICS = jobs.JobConfig.topics


class Called(Exception):
    pass


def settings(monkeypatch, owner, name, run):
    """Arguments, with defaults, of the first call of ``owner.name`` in ``run``."""
    own = inspect.signature(getattr(owner, name))

    def stop(*args, **kwargs):
        bound = own.bind(*args, **kwargs)
        bound.apply_defaults()
        raise Called(dict(bound.arguments))

    monkeypatch.setattr(owner, name, stop)
    with pytest.raises(Called) as caught:
        run()
    return caught.value.args[0]


@pytest.mark.parametrize("query", ["classifiers", "training_job"])
def test_classifiers_are_searched_in_full(monkeypatch, query):
    monkeypatch.setattr(model_queries, "feature_vectors", lambda *_: None)
    monkeypatch.setattr(model_queries, "scratch", lambda *_: "folder")
    monkeypatch.setattr(models, "train_lasso", lambda *_, **kw: {})
    used = settings(monkeypatch, models, "train_classifiers", lambda: catalog.QUERIES[query](None, ""))
    assert (used["n_iter"], used["k"], used["kinds"]) == (models.N_ITER_SEARCH, models.CV_FOLDS, None)
    assert used["spaces"] is None or used["spaces"] == models.SEARCH_SPACES


@pytest.mark.parametrize("query", ["feature_bundle", "feature_bundle_reload"])
def test_bundles_are_whole(monkeypatch, spark, data, query):
    used = settings(monkeypatch, features, "FeatureBundle", lambda: catalog.QUERIES[query](spark, data))
    assert (used["max_features"], used["semantic_components"], used["topics"]) == (vectorize.MAX_FEATURES, features.SEMANTIC_COMPONENTS, TOPICS)
    assert used["topic_iterations"] == topics.LDA_FEATURE_ITER


FITS = {
    "lda_topics": (topics, "fit_lda", {"topics": TOPICS, "max_iter": topics.LDA_MAX_ITER}),
    "lda_topic_words": (topics, "fit_lda", {"topics": TOPICS, "max_iter": topics.LDA_MAX_ITER}),
    "topic_model_reload": (topics, "fit_lda", {"topics": TOPICS, "max_iter": topics.LDA_MAX_ITER}),
    "nmf_topics": (topics, "fit_nmf", {"topics": TOPICS, "iterations": 20}),
    "svd_features": (features, "fit_lsa", {"components": features.SEMANTIC_COMPONENTS}),
    "svd_explained_variance": (features, "fit_lsa", {"components": features.SEMANTIC_COMPONENTS}),
    "tune_topics": (topics, "tune_topics", {"counts": list(range(10, 101, 5)), "n_words": 20, "max_iter": topics.LDA_MAX_ITER}),
}


@pytest.mark.parametrize("query", sorted(FITS))
def test_models_keep_the_vocabulary_and_their_defaults(monkeypatch, query):
    sizes = []

    class Rows:
        vocabulary = ["a"]

        def __getattr__(self, name):
            return lambda *args, **kwargs: self

    def vectorizer(df, text, method="count", max_features=vectorize.MAX_FEATURES):
        sizes.append(max_features)
        return Rows()

    monkeypatch.setattr(vector_queries, "documents", lambda *_: Rows())
    monkeypatch.setattr(vector_queries, "stage", lambda df, name: df)
    monkeypatch.setattr(vector_queries, "scratch", lambda *_: "folder")
    monkeypatch.setattr(vectorize, "fit_vectorizer", vectorizer)
    monkeypatch.setattr(vectorize, "terms_of", lambda *_: Rows())
    owner, name, wanted = FITS[query]
    used = settings(monkeypatch, owner, name, lambda: catalog.QUERIES[query](None, ""))
    assert sizes == [vectorize.MAX_FEATURES] and {k: used[k] for k in wanted} == wanted
