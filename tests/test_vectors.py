import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerlens.operators import features, lexicon, models, topics, vectorize
from tests.conftest import values

TEXTS = [
    (1, "revenue growth strong revenue"),
    (2, "growth weak demand"),
    (3, "revenue demand growth outlook outlook outlook"),
    (4, ""),
    (5, None),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "k int, t string").repartition(3)


def terms(text):
    words = [w for w in (text or "").split()]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_vocabulary_and_counts(spark, texts):
    model = vectorize.fit_vectorizer(texts, "t", "count", 6)
    cf = Counter(t for _, text in TEXTS for t in terms(text))
    expected = sorted(sorted(cf, key=lambda t: (-cf[t], t))[:6])
    assert model.vocabulary == expected
    cells = {(r["k"], r["term"]): r["tf"] for r in model.long(texts, "k").collect()}
    assert cells == {(k, t): n for k, text in TEXTS for t, n in Counter(terms(text)).items() if t in expected}


def test_max_document_frequency(spark, texts):
    stats = {r["term"]: (r["cf"], r["df"]) for r in vectorize.term_statistics(
        texts.select(vectorize.terms_of(F.coalesce("t", F.lit(""))).alias("terms"))).collect()}
    assert stats["revenue"] == (3, 2) and stats["outlook"] == (3, 1)
    model = vectorize.fit_vectorizer(texts, "t", "count", 100, max_df=0.4)
    assert "growth" not in model.vocabulary and "revenue" in model.vocabulary


def test_tfidf_matches_the_formula(spark, texts):
    model = vectorize.fit_vectorizer(texts, "t", "tfidf", 100)
    got = {(r["k"], r["term"]): r["x"] for r in model.long(texts, "k", "x").collect()}
    df = Counter(t for _, text in TEXTS for t in set(terms(text)))
    for k, text in TEXTS:
        weights = {t: n * (math.log((1 + 5) / (1 + df[t])) + 1) for t, n in Counter(terms(text)).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        for t, w in weights.items():
            assert got[(k, t)] == pytest.approx(w / norm)


def test_unknown_method_and_unfitted_use_raise(spark, texts):
    with pytest.raises(ValueError):
        vectorize.fit_vectorizer(texts, "t", "hash")
    with pytest.raises(ValueError):
        features.Embedder("tfidf").transform(texts)
    with pytest.raises(KeyError):
        features.combine_features(texts, ["semantic"], ["statistical"])


def test_saved_vectorizer_gives_the_same_vectors(spark, texts, tmp_path):
    model = vectorize.fit_vectorizer(texts, "t", "tfidf", 10)
    model.save(str(tmp_path / "m"))
    again = vectorize.FittedVectorizer.load(str(tmp_path / "m"))
    assert again.vocabulary == model.vocabulary and again.text == "t"
    assert sorted(values(again.long(texts, "k"))) == sorted(values(model.long(texts, "k")))


def brute_umass(docs, words):
    n = len(docs)
    total = []
    for i, a in enumerate(words):
        for b in words[:i]:
            both = sum(a in d and b in d for d in docs)
            total.append(math.log((both / n + 1e-12) / (sum(b in d for d in docs) / n)))
    return sum(total) / len(total)


def test_umass(spark, texts):
    top = spark.createDataFrame(
        [(0, 1, "growth"), (0, 2, "revenue"), (0, 3, "outlook"), (1, 1, "revenue"), (1, 2, "weak")],
        "topic int, rank int, term string",
    )
    tokens = F.split(F.coalesce("t", F.lit("")), " ")
    got = dict(values(topics.umass_coherence(texts, tokens, top)))
    assert dict(values(topics.umass_coherence(texts, tokens, top, topics_per_pass=1))) == pytest.approx(got)
    docs = [set((text or "").split()) for _, text in TEXTS]
    assert got[0] == pytest.approx(brute_umass(docs, ["growth", "revenue", "outlook"]))
    assert got[1] == pytest.approx(brute_umass(docs, ["revenue", "weak"]))


def test_best_topics_prefer_the_lower_id_on_ties(spark):
    df = spark.createDataFrame([(1, [0.2, 0.005, 0.4, 0.2, 0.01, 0.195])], "k int, s array<double>")
    assert values(topics.document_topics(df, "k", F.col("s"))) == [
        (1, 1, 2, 0.4), (1, 2, 0, 0.2), (1, 3, 3, 0.2), (1, 4, 5, 0.195),
    ]


def test_top_words_of_a_hot_topic(spark):
    rows = [(0, f"w{i:04d}", float(i % 100)) for i in range(2000)] + [(1, "only", 1.0)]
    top = topics.top_words(spark.createDataFrame(rows, "topic int, term string, weight double").repartition(6), 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()
    assert sorted(values(top)) == [(0, 1, "w0099", 99.0), (0, 2, "w0199", 99.0), (0, 3, "w0299", 99.0), (1, 1, "only", 1.0)]
    assert [r["term"] for r in topics.topic_words(top, 1).collect()] == ["only"]
    assert topics.topic_words(top, 9).collect() == []


def matrix(spark, rows=60, columns=12, seed=5):
    rng = np.random.default_rng(seed)
    dense = rng.random((rows, 3)) @ rng.random((3, columns)) * (rng.random((rows, columns)) > 0.3)
    dense[7] = 0.0
    data = [(i, Vectors.sparse(columns, [(j, float(x)) for j, x in enumerate(r) if x])) for i, r in enumerate(dense)]
    return dense, spark.createDataFrame(data, ["k", "v"]).repartition(4)


def test_lsa_against_full_svd(spark):
    dense, df = matrix(spark)
    model = features.fit_lsa(df, "v", 4)
    exact = np.linalg.svd(dense, compute_uv=False)[:4]
    assert model.singular_values == pytest.approx(exact, rel=1e-6)
    assert model.components.T @ model.components == pytest.approx(np.eye(4), abs=1e-8)
    scores = dict(values(model.transform(df, "v").select("k", "semantic")))
    assert np.array([scores[i] for i in range(60)]) == pytest.approx(dense @ model.components, abs=1e-9)
    shares = features.explained_variance(model.transform(df, "v"), "semantic", df, "v", 12)
    expected = (dense @ model.components).var(axis=0) / dense.var(axis=0).sum()
    assert [r["ratio"] for r in shares.orderBy("component").collect()] == pytest.approx(list(expected))


def test_lsa_with_parts_without_cells(spark):
    dense, df = matrix(spark)
    empty = spark.createDataFrame([(60 + i, Vectors.sparse(12, [], [])) for i in range(3)], ["k", "v"]).coalesce(1)
    both = df.unionByName(empty).unionByName(df.where("k < 0"))
    model = features.fit_lsa(both, "v", 4)
    assert model.singular_values == pytest.approx(np.linalg.svd(dense, compute_uv=False)[:4], rel=1e-6)
    scores = dict(values(model.transform(both, "v").select("k", "semantic")))
    assert np.array([scores[i] for i in range(63)]) == pytest.approx(np.r_[dense, np.zeros((3, 12))] @ model.components, abs=1e-9)


def test_nmf_error_falls(spark):
    dense, df = matrix(spark)
    model = topics.fit_nmf(df, "v", 3, iterations=12)
    assert all(b <= a + 1e-9 for a, b in zip(model.errors, model.errors[1:]))
    weights = dict(values(model.transform(df, "v").select("k", "weights")))
    w = np.array([weights[i] for i in range(60)])
    assert (w >= 0).all() and (model.components >= 0).all()
    assert ((dense - w @ model.components) ** 2).sum() <= model.errors[0]
    again = topics.fit_nmf(df.repartition(2), "v", 3, iterations=12)
    assert again.components == pytest.approx(model.components, rel=1e-6)


def test_lda_distributions_sum_to_one(spark):
    _, df = matrix(spark)
    model = topics.fit_lda(df, "v", 3, max_iter=3)
    rows = model.transform(df).select("k", vector_to_array("topic_vector").alias("s")).collect()
    assert all(sum(r["s"]) == pytest.approx(1.0) for r in rows if r["k"] != 7)
    best = topics.score_documents(model, df, "k", "v")
    assert values(best.where("k = 7")) == [(7, 1, 0, 1.0)]


def test_statistical_features(spark):
    df = spark.createDataFrame([("A b. C d.",), ("",), ("x",)], "t string")
    rows = [tuple(r["s"]) for r in df.select(features.statistical_features("t").alias("s")).collect()]
    assert rows == [(4.0, 9.0, 3.0, 1.5, 4 / 3), (0.0, 0.0, 1.0, 0.0, 0.0), (1.0, 1.0, 1.0, 1.0, 1.0)]


def test_column_alignment(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "k int, b double, extra double")
    assert features.column_changes(df, ["a", "b"], ["k"]) == {"missing": ["a"], "extra": ["extra"]}
    aligned = features.align_columns(df, ["a", "b"], ["k"])
    assert aligned.columns == ["k", "a", "b"] and values(aligned) == [(1, 0.0, 2.0)]
    assert features.nonzero_columns(aligned, ["a", "b"]) == ["b"]


def test_lasso_meets_its_optimality_conditions(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 5)) * np.array([1, 10, 0.1, 1, 3])
    y = x @ np.array([0.5, 0.0, 2.0, 0.0, -0.1]) + 0.3 + rng.standard_normal(400) * 0.1
    df = spark.createDataFrame([(i, float(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))],
                               "k int, y double, a array<double>")
    df = df.select("k", "y", array_to_vector("a").alias("features"))
    alpha = 0.02
    model = models.lasso(alpha, label="y").fit(df)
    w = model.coefficients.toArray()
    gradient = x.T @ (y - x @ w - model.intercept) / len(y)
    for g, c in zip(gradient, w):
        if c:
            assert g == pytest.approx(alpha * np.sign(c), abs=1e-4)
        else:
            assert abs(g) <= alpha + 1e-4
    trained = models.train_lasso(df, "k", "y", list("abcde"), alphas=3, k=3)
    assert trained["search"].count() == 3 and trained["test_metrics"].first()["r2"] > 0


def test_classifier_search(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 2))
    r = 0.05 + 0.1 * x[:, 0]
    df = spark.createDataFrame([(i, float(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, r))],
                               "k int, r double, a array<double>").select("k", "r", array_to_vector("a").alias("features"))
    spaces = {"LogisticRegression": models.SEARCH_SPACES["LogisticRegression"],
              "RandomForest": {"trees": [5], "depth": [3]}}
    done = models.train_classifiers(df, "k", "r", n_iter=1, k=2, spaces=spaces)
    scores = {row["model"]: row["test_f1_macro"] for row in done["results"].collect()}
    assert scores[done["best"]] == max(scores.values()) > 0.5
    row = models.evaluate_classifier(done["models"]["RandomForest"], done["test"]).first()
    assert 0.5 < row["roc_auc"] <= 1.0
    summary = models.cross_validate(models.build("RandomForest", {"trees": 3}), done["test"], "k", k=2,
                                    scoring=["f1_macro"])
    assert sorted((r["side"], r["metric"], len(r["values"])) for r in summary.collect()) == [
        ("test", "f1_macro", 2), ("train", "f1_macro", 2)]


def test_plugin_encoder_and_bundle_names(spark, texts):
    coded = features.encode_texts(texts, "k", "t", lambda: lambda batch: [[len(t)] for t in batch], batch=2)
    assert dict((k, v[0]) for k, v in values(coded)) == {k: float(len(t or "")) for k, t in TEXTS}
    bundle = features.FeatureBundle("t", 10, 2, 2, semantic=False, topic_iterations=2).fit(texts.fillna({"t": ""}))
    out = bundle.transform(texts.fillna({"t": ""}))
    assert bundle.names() == ["stat_0", "stat_1", "stat_2", "stat_3", "stat_4", "topic_0", "topic_1"]
    assert out.select(F.size(vector_to_array("features"))).first()[0] == 7


def test_saved_models_give_the_same_results(spark, texts, tmp_path):
    from ledgerlens.sources import models as saved

    filled = texts.fillna({"t": ""})
    bundle = features.FeatureBundle("t", 8, 2, 2, topic_iterations=2).fit(filled)
    saved.save_features(spark, bundle, str(tmp_path / "b"))
    again = saved.load_features(spark, str(tmp_path / "b"))
    assert again.names() == bundle.names()
    one, two = (
        dict(values(b.transform(filled).select("k", vector_to_array("features")))) for b in (bundle, again)
    )
    assert all(two[k] == pytest.approx(one[k]) for k in one)
    _, df = matrix(spark)
    nmf = topics.fit_nmf(df, "v", 2, iterations=2)
    saved.save_topic_model(spark, nmf, ["w"] * 12, str(tmp_path / "n"))
    loaded, vocabulary = saved.load_topic_model(spark, str(tmp_path / "n"))
    assert vocabulary == ["w"] * 12 and loaded.components == pytest.approx(nmf.components)
    table = lexicon.lexicon_table(spark)
    saved.save_lexicon(table, str(tmp_path / "l"))
    assert sorted(values(saved.load_lexicon(spark, str(tmp_path / "l")))) == sorted(values(table))


def test_word_vectors_of_exactly_the_first_terms(spark):
    """Of words with equal counts those inside the bound keep their vectors."""
    rows = [("apple apple apple berry berry cherry cherry damson damson",), ("zebra zebra apple",), (None,), ("",)]
    df = spark.createDataFrame(rows, "text string")
    for bound, want in ((1, {"apple"}), (3, {"apple", "berry", "cherry"}), (9, {"apple", "berry", "cherry", "damson", "zebra"})):
        model = features.fit_word_vectors(df, "text", 4, min_count=2, parts=1, max_terms=bound)
        assert {r["word"] for r in model.getVectors().collect()} == want
        assert features.word_vector_embeddings(model, df, "text").count() == 4


def test_nmf_handles_few_cells_at_once():
    """The numbers that a task makes at once, cells x topics, stay in its caches."""
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"i": [np.arange(50)] * 1000, "x": list(rng.random((1000, 50)))})
    sizes = [len(values) for *_, values in topics._weigher()(frame, rng.random((3, 50)), 2)]
    assert sum(sizes) == 50_000 and max(sizes) <= 20_000
