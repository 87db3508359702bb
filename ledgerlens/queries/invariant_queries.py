"""Queries whose rows state what must hold of fitted models, saved files and registries, so that SQL can say them too."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens.operators import features, models, split, topics, versions
from ledgerlens.plans import jobs
from ledgerlens.queries.model_queries import FEATURES, feature_vectors
from ledgerlens.queries.registry import documents, query, reports, scratch, table, with_reports
from ledgerlens.queries.table_queries import registry
from ledgerlens.queries.vector_queries import matrix
from ledgerlens.session import stage
from ledgerlens.sources import models as saved

TOPICS, TERMS = jobs.JobConfig.topics, 5000


def total(weights):
    return F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)


@query("lda_distributions", "SELECT doc_id, TRUE AS sums_to_one FROM documents")
def lda_distributions(spark, folder):
    """Every document has topic weights that sum to 1; one without known terms has the single weight of the default."""
    vectors, _ = matrix(spark, folder, TERMS)
    scored = topics.fit_lda(vectors, "vector", TOPICS).transform(vectors)
    weights = F.when(F.size(F.unwrap_udt("vector")["indices"]) == 0, F.array(F.lit(1.0))).otherwise(vector_to_array("topic_vector"))
    return scored.select("doc_id", (F.abs(total(weights) - 1) < 1e-6).alias("sums_to_one"))


@query(
    "topics_of_empty_documents",
    """SELECT doc_id, 'text' AS kind, TRUE AS in_order, NULL::INTEGER AS topic, NULL::DOUBLE AS score FROM documents
    UNION ALL SELECT doc_id, 'empty', TRUE, 0, 1.0 FROM documents""",
)
def topics_of_empty_documents(spark, folder):
    """Best topics of every document come in falling order; with its text taken away it has topic 0 with score 1 alone."""
    vectors, vectorizer = matrix(spark, folder, TERMS)
    model = topics.fit_lda(vectors, "vector", TOPICS)
    bare = vectorizer.transform(documents(spark, folder).select("doc_id", F.lit("").alias("text"))).select("doc_id", "vector")
    out = []
    for kind, rows in (("text", vectors), ("empty", bare)):
        listed = F.array_sort(F.collect_list(F.struct("rank", "topic", "score")))
        found = topics.score_documents(model, rows, "doc_id", "vector").groupBy("doc_id").agg(listed.alias("l"))
        ranks, scores, only = F.col("l.rank"), F.col("l.score"), (F.size("l") == 1) & F.lit(kind == "empty")
        in_order = (ranks == F.sequence(F.lit(1), F.size("l"))) & (scores == F.sort_array(scores, asc=False))
        out.append(found.select(
            "doc_id", F.lit(kind).alias("kind"), in_order.alias("in_order"),
            F.when(only, F.col("l")[0]["topic"].cast("int")).alias("topic"), F.when(only, F.col("l")[0]["score"]).alias("score"),
        ))
    return out[0].unionByName(out[1])


@query("topic_model_reload_equal", "SELECT doc_id, TRUE AS same FROM documents")
def topic_model_reload_equal(spark, folder):
    """A topic model that was saved and loaded gives each document the weights that it gave before."""
    vectors, vectorizer = matrix(spark, folder, TERMS)
    model, path = topics.fit_lda(vectors, "vector", TOPICS), scratch(spark, "topic-model-equal")
    saved.save_topic_model(spark, model, vectorizer.vocabulary, path)
    loaded, _ = saved.load_topic_model(spark, path)
    before = model.transform(vectors).withColumn("before", vector_to_array("topic_vector")).drop("topic_vector")
    both = loaded.transform(before).withColumn("after", vector_to_array("topic_vector"))
    near = F.forall(F.arrays_zip("before", "after"), lambda p: F.abs(p["before"] - p["after"]) < 1e-6)
    return both.select("doc_id", near.alias("same"))


@query(
    "hook_clipped_returns",
    with_reports(
        """SELECT report_id, round(least(greatest(bhar0_2, -0.04), 0.06), 9) AS bhar0_2, bhar0_2 IS NULL AS missing,
        CASE WHEN bhar0_2 > 0.05 THEN 1 ELSE 0 END AS label, CASE WHEN bhar0_2 > 0.06 THEN 1 ELSE 0 END AS was_high FROM reports"""
    ),
)
def hook_clipped_returns(spark, folder):
    """A hook of the data job: it clips the returns and marks high ones, before the label is taken from them."""

    def clip(df):
        bounded = F.when(F.col("bhar0_2").isNotNull(), F.least(F.greatest("bhar0_2", F.lit(-0.04)), F.lit(0.06)))
        return df.withColumn("was_high", (F.coalesce(F.col("bhar0_2"), F.lit(0.0)) > 0.06).cast("int")).withColumn("bhar0_2", bounded)

    config = jobs.JobConfig(key="report_id", returns="bhar0_2", financial_hook=clip)
    prepared = jobs.prepare(reports(spark, folder), config)
    return prepared.select("report_id", F.round("bhar0_2", 9).alias("bhar0_2"), F.col("bhar0_2").isNull().alias("missing"), "label", "was_high")


@query(
    "svd_orthonormal",
    f"""SELECT a.i::INTEGER AS i, b.i::INTEGER AS j, (a.i = b.i)::INTEGER AS product
    FROM range({features.SEMANTIC_COMPONENTS}) a(i), range({features.SEMANTIC_COMPONENTS}) b(i)""",
)
def svd_orthonormal(spark, folder):
    """Products of the components of the semantic features: 1 with themselves, 0 with each other."""
    vectors, _ = matrix(spark, folder, TERMS, "tfidf")
    size = features.SEMANTIC_COMPONENTS
    components = np.asarray(features.fit_lsa(vectors, "vector", size).components)
    if components.shape[0] != size:
        components = components.T
    product = np.rint((components @ components.T) * 1e6) / 1e6
    rows = [(i, j, int(round(product[i, j]))) for i in range(size) for j in range(size) if abs(product[i, j] - round(product[i, j])) < 1e-5]
    return spark.createDataFrame(rows, "i int, j int, product int")


@query("nmf_weights", "SELECT doc_id, TRUE AS non_negative, TRUE AS error_falls FROM documents")
def nmf_weights(spark, folder):
    """Weights of all documents are not negative, and the error of the factorisation never rises."""
    vectors, _ = matrix(spark, folder, TERMS, "tfidf")
    model = topics.fit_nmf(vectors, "vector", TOPICS)
    falls = all(b <= a * (1 + 1e-9) for a, b in zip(model.errors, model.errors[1:]))
    found = model.transform(vectors, "vector")
    return found.select("doc_id", F.forall("weights", lambda w: w >= 0).alias("non_negative"), F.lit(falls).alias("error_falls"))


LASSO_ALPHA = 1e-4


@query("lasso_optimality", "SELECT unnest([" + ", ".join(f"'{f}'" for f in FEATURES) + "]) AS feature, TRUE AS optimal")
def lasso_optimality(spark, folder):
    """The optimality condition of every coefficient, from the gradient over all rows.

    The gradient of the squared error is alpha times the sign of a coefficient, or at most alpha where it is 0.
    """
    rows = feature_vectors(spark, folder)
    fitted = models.lasso(LASSO_ALPHA, label="bhar0_2").fit(rows)
    rest = F.col("bhar0_2") - F.col("prediction")
    cells = fitted.transform(rows).select(rest.alias("rest"), F.posexplode(vector_to_array("features")).alias("position", "x"))
    gradient = cells.groupBy("position").agg(F.avg(F.col("x") * F.col("rest")).alias("g"))
    table = models.coefficient_table(spark, fitted.coefficients, FEATURES).join(gradient, "position")
    size = F.lit(LASSO_ALPHA)
    exact = F.abs(F.col("g") - size * F.signum("importance")) < 1e-6
    return table.select("feature", F.when(F.col("importance") != 0, exact).otherwise(F.abs("g") <= size + 1e-6).alias("optimal"))


WIDE_TERMS, WIDE_ALPHAS = 500, [0.01, 0.001, 0.0001]


@query(
    "lasso_path_optimality",
    f"SELECT alpha::DOUBLE AS alpha, i::INTEGER AS position, TRUE AS optimal FROM (VALUES {', '.join(f'({a})' for a in WIDE_ALPHAS)}) a(alpha), range({WIDE_TERMS}) t(i)",
)
def lasso_path_optimality(spark, folder):
    """The optimality condition of each of 500 term weights, for three models of the length of a text that share one pass.

    The gradient is taken again from the rows, not from the sums that the models were solved on.
    """
    vectors, _ = matrix(spark, folder, WIDE_TERMS, "tfidf")
    docs = table(spark, folder, "documents").select("doc_id", F.log1p(F.length("text")).alias("y"))
    rows = stage(vectors.join(docs, "doc_id").withColumn("fold", F.lit(0)), "wide")
    sums = models.fold_moments(rows, 1, "y", "vector").sum(axis=0)
    fitted = models.lasso_path(sums, WIDE_ALPHAS)
    gradients = models.lasso_gradients(rows, "y", "vector", fitted)
    # Alphas x features rows.
    table_rows = [
        (alpha, i, float(gradients[m][i]) if gradients is not None else None, float(b[i]))
        for m, (alpha, (b, _)) in enumerate(zip(WIDE_ALPHAS, fitted))
        for i in range(len(b))
    ]
    found = spark.createDataFrame(table_rows, "alpha double, position int, g double, b double")
    exact = F.abs(F.col("g") - F.col("alpha") * F.signum("b")) < 1e-8
    optimal = F.when(F.col("b") != 0, exact).otherwise(F.abs("g") <= F.col("alpha") + 1e-8)
    return found.select("alpha", "position", optimal.alias("optimal"))


@query(
    "svm_ranking",
    with_reports(
        """SELECT count(*) > 0 AND count(DISTINCT bhar0_2 > 0.05) = 2 AS has_auc, TRUE AS within_bounds FROM reports"""
    ),
)
def svm_ranking(spark, folder):
    """A linear support vector machine has a ROC AUC, as its raw score ranks the rows."""
    rows = split.add_label(feature_vectors(spark, folder), "bhar0_2")
    model = models.build("SVM", {"C": 1.0}, rows=rows.count()).fit(rows)
    auc = models.evaluate_classifier(model, rows)
    return auc.select(F.col("roc_auc").isNotNull().alias("has_auc"), F.col("roc_auc").between(0.0, 1.0).alias("within_bounds"))


@query(
    "cross_validate_scoring",
    """SELECT side, metric, 5 AS folds FROM (VALUES ('test'), ('train')) s(side), (VALUES ('accuracy'), ('f1_macro')) m(metric)""",
)
def cross_validate_scoring(spark, folder):
    """Cross-validation that reports the metrics asked for only (K4), with the number of fold values."""
    rows = split.add_label(feature_vectors(spark, folder), "bhar0_2")
    estimator = models.build("LogisticRegression", {"C": 1.0}, rows=rows.count())
    found = models.cross_validate(estimator, rows, "report_id", "label", scoring=["accuracy", "f1_macro"])
    return found.select("side", "metric", F.size("values").alias("folds"))


@query("version_list", with_reports("SELECT DISTINCT segment AS version_id FROM reports"))
def version_list(spark, folder):
    """All versions of a registry with many entries for each."""
    return written_registry(spark, folder).list()


@query(
    "version_entry",
    with_reports("SELECT segment AS version_id, strftime(max(report_date), '%Y-%m-%d') AS created_at FROM reports WHERE segment = (SELECT min(segment) FROM reports) GROUP BY segment"),
)
def version_entry(spark, folder):
    """The valid entry of one version."""
    found = written_registry(spark, folder)
    first = found.list().agg(F.min("version_id")).first()[0]
    entry = found.info(first)
    return spark.createDataFrame([(entry["version_id"], entry["created_at"])], "version_id string, created_at timestamp").select(
        "version_id", F.date_format("created_at", "yyyy-MM-dd").alias("created_at")
    )


def written_registry(spark, folder) -> versions.VersionRegistry:
    path = scratch(spark, "registry")
    rows = registry(spark, folder).select("version_id", F.col("created_at").cast("timestamp").alias("created_at"), "description", "config")
    rows.write.mode("overwrite").parquet(path)
    return versions.VersionRegistry(spark, path)


@query(
    "column_changes",
    "SELECT * FROM (VALUES ('extra', 'lang'), ('extra', 'n_chars'), ('extra', 'source'), ('missing', 'title')) t(change, name)",
)
def column_changes(spark, folder):
    """Which columns an alignment would add and drop."""
    found = features.column_changes(table(spark, folder, "documents"), ["text", "title"], ["doc_id"])
    return spark.createDataFrame([(kind, name) for kind, names in found.items() for name in names], "change string, name string")


@query(
    "label_of_nan",
    with_reports("SELECT report_id, CASE WHEN report_id % 3 <> 0 AND bhar0_2 > 0.05 THEN 1 ELSE 0 END AS label FROM reports"),
)
def label_of_nan(spark, folder):
    """A return that is NaN counts as missing and gets the label 0."""
    nan = F.when(F.col("report_id") % 3 == 0, float("nan")).otherwise(F.col("bhar0_2"))
    return split.add_label(reports(spark, folder).select("report_id", nan.alias("bhar0_2")), "bhar0_2").select("report_id", "label")


@query(
    "analysis_files",
    with_reports(
        """SELECT name, (SELECT count(*) FROM reports) AS n
        FROM (VALUES ('embeddings'), ('features'), ('sentiment'), ('topic_distributions'), ('vectors')) t(name)"""
    ),
)
def analysis_files(spark, folder):
    """Rows of each table that the analysis job writes, plus the rows it holds out: all reports."""
    from ledgerlens.plans import jobs

    config = jobs.JobConfig(returns="bhar0_2", columnar_input=False)
    rows = stage(reports(spark, folder), "analysis-reports")
    done = jobs.full_job(rows, scratch(spark, "analysis-job"), config, "reports")
    held = done["splits"].where("split <> 'train'").count()
    out = None
    for name in ("embeddings", "features", "sentiment", "topic_distributions", "vectors"):
        one = spark.read.parquet(f"{done['folder']}/{name}").agg((F.count(F.lit(1)) + held).alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out
