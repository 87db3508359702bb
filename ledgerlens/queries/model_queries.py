"""Queries on evaluation, importances, models and whole jobs."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerlens.functions import metrics, sentiment, signals
from ledgerlens.functions.wordlists import KEYWORD_TOPICS
from ledgerlens.operators import evaluate, features, models, split
from ledgerlens.plans import jobs
from ledgerlens.queries import sql_text as q
from ledgerlens.queries.registry import query, reports, scratch, table, with_reports, with_tables
from ledgerlens.queries.table_queries import METRICS_SQL
from ledgerlens.session import compact, stage
from ledgerlens.sources import models as saved

ORDER_TOTALS_SQL = """
totals AS (SELECT l_orderkey, sum(l_extendedprice) / 1000 AS p FROM lineitem GROUP BY l_orderkey),
pairs AS (SELECT o_orderkey, o_orderpriority, o_totalprice / 1000 AS y, p
  FROM orders JOIN totals ON l_orderkey = o_orderkey)"""


def order_totals(spark, folder):
    """Order price as truth and the sum of its lines as prediction, in thousands."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        (F.sum("l_extendedprice") / 1000).alias("p")
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", (F.col("o_totalprice") / 1000).alias("y")
    )
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).drop("l_orderkey")


MEASURES_SQL = """avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
  1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2"""
MEASURES = ["mse", "rmse", "mae", "r2"]


@query(
    "regression_metrics",
    with_tables(
        f"SELECT {q.rounded(MEASURES, 4)} FROM (SELECT {MEASURES_SQL} FROM pairs)", ORDER_TOTALS_SQL
    ),
)
def regression_metrics(spark, folder):
    measured = evaluate.regression_metrics(order_totals(spark, folder), "y", "p")
    return measured.select(*[F.round(c, 4).alias(c) for c in MEASURES])


AUC_SQL = """SELECT NAME AS source, round(sum(pos * (below + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS roc_auc,
  CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
    SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM TABLE GROUP BY score))"""


@query(
    "roc_auc",
    with_reports(
        AUC_SQL.replace("NAME", "'reports'").replace("TABLE", "by_sentiment")
        + " UNION ALL "
        + AUC_SQL.replace("NAME", "'documents'").replace("TABLE", "by_length"),
        q.scores_table("reports", "report_id", "ea_text", keep=", bhar0_2"),
        "by_sentiment AS (SELECT net_sentiment AS score, CASE WHEN bhar0_2 > 0.05 THEN 1 ELSE 0 END AS label FROM scores)",
        "by_length AS (SELECT n_chars AS score, quality AS label FROM documents JOIN labels USING (doc_id))",
    ),
)
def roc_auc(spark, folder):
    """Net sentiment against the return label, and text length against quality."""
    scored = reports(spark, folder).select("bhar0_2", sentiment.lexicon_scores("ea_text")["net_sentiment"].alias("net"))
    first = evaluate.roc_auc(split.add_label(scored, "bhar0_2"), "net", "label")
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    second = evaluate.roc_auc(docs, "n_chars", "quality")
    both = first.withColumn("source", F.lit("reports")).unionByName(second.withColumn("source", F.lit("documents")))
    return both.select("source", F.round("roc_auc", 6).alias("roc_auc"), "positives", "negatives")


@query(
    "cv_summary",
    with_tables(
        """SELECT metric, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std,
        count(*) AS folds, round(arg_min(value, fold), 4) AS first_value FROM long GROUP BY metric""",
        ORDER_TOTALS_SQL,
        f"fold_scores AS (SELECT o_orderpriority AS fold, {MEASURES_SQL} FROM pairs GROUP BY o_orderpriority)",
        """long AS (SELECT 'r2' AS metric, fold, r2 AS value FROM fold_scores
        UNION ALL SELECT 'neg_rmse', fold, -rmse FROM fold_scores UNION ALL SELECT 'rmse', fold, rmse FROM fold_scores)""",
    ),
)
def cv_summary(spark, folder):
    """Scores per fold and their summary; the order priorities are the folds."""
    scored = evaluate.regression_metrics(order_totals(spark, folder), "y", "p", ["o_orderpriority"])
    wide = scored.select(F.col("o_orderpriority").alias("fold"), "r2", (-F.col("rmse")).alias("neg_rmse"))
    summary = evaluate.summarise_folds(wide.unpivot("fold", ["r2", "neg_rmse"], "metric", "value"))
    return summary.select(
        "metric",
        F.round("mean", 4).alias("mean"),
        F.round("std", 4).alias("std"),
        F.size("values").cast("long").alias("folds"),
        F.round(F.col("values")[0], 4).alias("first_value"),
    )


# Threshold rules stand in for fitted models.
RULES = {
    "net_any": ("net_sentiment > 0", lambda s: s["net_sentiment"] > 0),
    "net_high": ("net_sentiment > 0.05", lambda s: s["net_sentiment"] > 0.05),
    "positive_high": ("positive > 0.06", lambda s: s["positive"] > 0.06),
}
RULE_SQL = [
    q.scores_table("reports", "report_id", "ea_text", keep=", bhar0_2"),
    "predictions AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS model, CASE WHEN bhar0_2 > 0.05 THEN 1 ELSE 0 END AS y, "
        f"CASE WHEN {sql} THEN 1 ELSE 0 END AS p FROM scores"
        for name, (sql, _) in RULES.items()
    )
    + ")",
    "classes AS (SELECT DISTINCT model, class FROM (SELECT model, y AS class FROM predictions "
    "UNION ALL SELECT model, p FROM predictions))",
    """class_counts AS (SELECT c.model, c.class, count(*) FILTER (y = class AND p = class) AS hit,
      count(*) FILTER (y = class) AS support, count(*) FILTER (p = class) AS predicted
      FROM classes c JOIN predictions d ON d.model = c.model GROUP BY ALL""" + ")",
    """class_scores AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS pr,
      CASE WHEN support = 0 THEN 0 ELSE hit / support END AS re FROM class_counts)""",
    """rule_scores AS (SELECT model, sum(hit) / sum(support) AS accuracy, avg(pr) AS precision_macro,
      avg(re) AS recall_macro, avg(CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END) AS f1_macro
      FROM class_scores GROUP BY model)""",
]
MACRO = ["accuracy", "precision_macro", "recall_macro", "f1_macro"]


def rule_scores(spark, folder):
    scored = reports(spark, folder).select("bhar0_2", sentiment.lexicon_scores("ea_text").alias("s"))
    labelled = split.add_label(scored, "bhar0_2")
    rows = [
        F.struct(F.lit(name).alias("model"), rule(F.col("s")).cast("int").alias("prediction"))
        for name, (_, rule) in RULES.items()
    ]
    predictions = labelled.select("label", F.inline(F.array(*rows)))
    return evaluate.classifier_metrics(predictions, "label", "prediction", ["model"])


@query("classifier_metrics", with_reports(f"SELECT model, {q.rounded(MACRO)} FROM rule_scores", *RULE_SQL))
def classifier_metrics(spark, folder):
    return rule_scores(spark, folder).select("model", *[F.round(c, 6).alias(c) for c in MACRO])


@query(
    "best_model",
    with_reports(
        """SELECT model, round(f1_macro, 6) AS test_f1_macro FROM rule_scores ORDER BY f1_macro DESC, model LIMIT 1""",
        *RULE_SQL,
    ),
)
def best_model(spark, folder):
    results = rule_scores(spark, folder).withColumnRenamed("f1_macro", "test_f1_macro")
    best = evaluate.best_model(results)
    return best.select("model", F.round("test_f1_macro", 6).alias("test_f1_macro"))


# Correlations with the return stand in for model coefficients where SQL has to agree.
FEATURES = ["positive", "negative", "uncertainty", "litigious", "net_sentiment", "sentiment_ratio", "chars", "words"]
GROUPS = {
    "polarity": ["positive", "negative", "net_sentiment", "sentiment_ratio"],
    "doubt": ["uncertainty", "litigious", "hedging"],
    "length": ["chars", "words"],
}
COEFFICIENT_SQL = [
    q.scores_table("reports", "report_id", "ea_text", keep=", bhar0_2, ea_text"),
    f"wide AS (SELECT *, length(ea_text) AS chars, {q.word_count('ea_text')} AS words FROM scores)",
    "coefficients AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{f}' AS feature, corr({f}, bhar0_2) AS importance FROM wide"
        for i, f in enumerate(FEATURES)
    )
    + ")",
]
GROUP_SQL = "groups(grp, feature) AS (VALUES " + ", ".join(
    f"('{g}', '{f}')" for g, names in GROUPS.items() for f in names
) + ")"


def feature_rows(spark, folder):
    scored = reports(spark, folder).select(
        "report_id",
        "bhar0_2",
        sentiment.lexicon_scores("ea_text").alias("s"),
        F.length("ea_text").alias("chars"),
        features.statistical_features("ea_text")["word_count"].alias("words"),
    )
    return scored.select("report_id", "bhar0_2", "s.*", "chars", "words")


def coefficients(spark, folder):
    row = feature_rows(spark, folder).agg(*[F.corr(f, "bhar0_2").alias(f) for f in FEATURES])
    named = [
        F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), F.col(f).alias("importance"))
        for i, f in enumerate(FEATURES)
    ]
    return row.select(F.inline(F.array(*named)))


@query(
    "top_coefficients",
    with_reports(
        """SELECT feature, round(importance, 6) AS importance, CAST(row_number() OVER (
          ORDER BY abs(importance) DESC, feature) AS INTEGER) AS place FROM coefficients
        ORDER BY abs(importance) DESC, feature LIMIT 5""",
        *COEFFICIENT_SQL,
    ),
)
def top_coefficients(spark, folder):
    top = models.top_features(coefficients(spark, folder), 5)
    ordered = top.agg(F.sort_array(F.collect_list(F.struct((-F.abs("importance")).alias("o"), "feature", "importance"))).alias("a"))
    listed = ordered.select(F.posexplode("a").alias("i", "x"))
    return listed.select("x.feature", F.round("x.importance", 6).alias("importance"), (F.col("i") + 1).alias("place"))


@query(
    "top_coefficients_signed",
    with_reports(
        """SELECT feature, round(importance, 6) AS importance FROM (SELECT * FROM coefficients
        ORDER BY abs(importance) DESC, feature LIMIT 6) ORDER BY importance, feature""",
        *COEFFICIENT_SQL,
    ),
)
def top_coefficients_signed(spark, folder):
    top = models.top_features_signed(coefficients(spark, folder), 6)
    return top.select("feature", F.round("importance", 6).alias("importance"))


@query(
    "coefficient_extremes",
    with_reports(
        """SELECT count(*) FILTER (importance <> 0) AS nonzero, arg_max(feature, importance) AS most_positive,
        round(max(importance), 6) AS most_positive_coef, arg_min(feature, importance) AS most_negative,
        round(min(importance), 6) AS most_negative_coef FROM coefficients""",
        *COEFFICIENT_SQL,
    ),
)
def coefficient_extremes(spark, folder):
    extremes = models.coefficient_extremes(coefficients(spark, folder))
    return extremes.select(
        "nonzero",
        "most_positive",
        F.round("most_positive_coef", 6).alias("most_positive_coef"),
        "most_negative",
        F.round("most_negative_coef", 6).alias("most_negative_coef"),
    )


@query(
    "group_importance",
    with_reports(
        """SELECT g.grp AS "group", round(sum(abs(coalesce(c.importance, 0))), 6) AS importance
        FROM groups g LEFT JOIN coefficients c ON c.feature = g.feature GROUP BY g.grp""",
        *COEFFICIENT_SQL,
        GROUP_SQL,
    ),
)
def group_importance(spark, folder):
    groups = spark.createDataFrame(
        [(g, f) for g, names in GROUPS.items() for f in names], "group string, feature string"
    )
    result = models.group_importance(coefficients(spark, folder), groups)
    return result.select("group", F.round("importance", 6).alias("importance"))


@query(
    "text_scoring",
    with_reports(
        f"""SELECT s.report_id, {q.word_count('s.ea_text')} AS word_count, {", ".join(
            f"round(s.{c}, 6) AS {c}" for c in q.SCORES)},
        CASE WHEN net_sentiment > 0.2 THEN 'Positive' WHEN net_sentiment < -0.2 THEN 'Negative' ELSE 'Neutral' END
          AS summary_class,
        CASE WHEN net_sentiment > 0.5 THEN 'strong_up' WHEN net_sentiment > 0.2 THEN 'slight_up'
          WHEN net_sentiment < -0.5 THEN 'strong_down' WHEN net_sentiment < -0.2 THEN 'slight_down' ELSE 'neutral' END AS band,
        {", ".join(metrics.METRIC_PATTERNS)}
        FROM scores s JOIN metrics m ON m.report_id = s.report_id""",
        q.scores_table("reports", "report_id", "ea_text", keep=", ea_text"),
        METRICS_SQL,
    ),
)
def text_scoring(spark, folder):
    """Everything that can be said about each text, in one pass."""
    scored = jobs.score_texts(reports(spark, folder), "report_id", "ea_text")
    return scored.select(
        "report_id",
        F.col("word_count").cast("long").alias("word_count"),
        *[F.round(c, 6).alias(c) for c in q.SCORES],
        "summary_class",
        "band",
        *metrics.METRIC_PATTERNS,
    )


def keyword_ids() -> str:
    """SQL list of the keyword topics with two hits or more."""
    items = []
    for number, words in enumerate(KEYWORD_TOPICS.values()):
        hits = " + ".join(f"contains(low, '{w}')::INTEGER" for w in words)
        items.append(f"CASE WHEN {hits} >= 2 THEN {number} END")
    return "list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL)"


@query(
    "text_scoring_details",
    with_reports(
        f"""SELECT report_id, array_to_string({keyword_ids()}, '|') AS keyword_topics,
        concat_ws('|', CASE WHEN contains(low, 'revenue') THEN CASE
            WHEN contains(low, 'growth') OR contains(low, 'increase') THEN 'revenue_up'
            WHEN contains(low, 'decline') OR contains(low, 'decrease') THEN 'revenue_down' END END,
          CASE WHEN contains(low, 'margin') THEN CASE
            WHEN contains(low, 'expanded') OR contains(low, 'increase') THEN 'margin_up'
            WHEN contains(low, 'contracted') OR contains(low, 'decrease') THEN 'margin_down' END END) AS insights,
        concat_ws('|', CASE WHEN contains(low, 'growth') OR contains(low, 'increase') THEN 'growth' END,
          CASE WHEN contains(low, 'decline') OR contains(low, 'decrease') THEN 'decline' END) AS factors
        FROM (SELECT report_id, lower(ea_text) AS low FROM reports)"""
    ),
)
def text_scoring_details(spark, folder):
    """The nested results of the same pass."""
    scored = jobs.score_texts(reports(spark, folder), "report_id", "ea_text")
    ids = F.transform("keyword_topics", lambda t: t["topic_id"].cast("string"))
    # The made reports name neither guidance nor a changed margin; "none" stands for no insight.
    insights = F.array_remove("insights", signals.NO_INSIGHT)
    return scored.select(
        "report_id", F.array_join(ids, "|").alias("keyword_topics"),
        F.array_join(insights, "|").alias("insights"), F.array_join("factors", "|").alias("factors"),
    )


# Rows of a file of feature vectors; fits that hold the rows of a task hold at most 32 files of them.
FEATURE_FILE_ROWS = 20_000


def feature_vectors(spark, folder):
    rows = feature_rows(spark, folder)
    vector = array_to_vector(F.array(*[F.col(f).cast("double") for f in FEATURES]))
    return compact(stage(rows.select("report_id", "bhar0_2", vector.alias("features")), "report-features", FEATURE_FILE_ROWS))


@query("lasso_fit")
def lasso_fit(spark, folder):
    """Coefficients of a Lasso on report features."""
    fitted = models.lasso(1e-4, label="bhar0_2").fit(feature_vectors(spark, folder))
    return models.coefficient_table(spark, fitted.coefficients, FEATURES)


@query("lasso_nonzero")
def lasso_nonzero(spark, folder):
    """Coefficients other than 0 of a Lasso, highest first."""
    fitted = models.lasso(1e-4, label="bhar0_2").fit(feature_vectors(spark, folder))
    return models.nonzero_coefficients(models.coefficient_table(spark, fitted.coefficients, FEATURES))


@query("lasso_search")
def lasso_search(spark, folder):
    """Random search over alpha with cross-validation: score of every candidate."""
    trained = models.train_lasso(feature_vectors(spark, folder), "report_id", "bhar0_2", FEATURES)
    return trained["search"]


@query("classifiers")
def classifiers(spark, folder):
    """Random search over four kinds of classifiers: best candidate and scores of each kind."""
    trained = models.train_classifiers(feature_vectors(spark, folder), "report_id", "bhar0_2")
    return trained["results"]


@query("cross_validate")
def cross_validate(spark, folder):
    """Fold scores of a logistic regression, train and test side."""
    labelled = split.add_label(feature_vectors(spark, folder), "bhar0_2")
    estimator = models.build("LogisticRegression", {"C": 1.0}, rows=labelled.count())
    return models.cross_validate(estimator, labelled, "report_id", "label")


@query("forest_report")
def forest_report(spark, folder):
    """A random forest of 50 trees and its report on the validation part."""
    labelled = split.add_label(feature_vectors(spark, folder), "bhar0_2")
    parts = compact(stage(split.stratified_split(labelled, "report_id"), "forest-parts"))
    model = models.build("RandomForest", {"trees": 50, "depth": 5}).fit(parts.where("split = 'train'"))
    scored = model.transform(parts.where("split = 'val'"))
    return evaluate.classification_report(scored, "label", "prediction")


@query("evaluate_classifier")
def evaluate_classifier(spark, folder):
    labelled = split.add_label(feature_vectors(spark, folder), "bhar0_2")
    parts = compact(stage(split.stratified_split(labelled, "report_id"), "evaluate-parts"))
    train = parts.where("split = 'train'")
    model = models.build("LogisticRegression", {"C": 1.0}, rows=train.count()).fit(train)
    return models.evaluate_classifier(model, parts.where("split = 'test'"))


@query("feature_importance")
def feature_importance(spark, folder):
    labelled = split.add_label(feature_vectors(spark, folder), "bhar0_2")
    model = models.build("RandomForest", {"trees": 50, "depth": 5}).fit(labelled)
    return models.feature_importance(spark, model, FEATURES)


@query("feature_bundle")
def feature_bundle(spark, folder):
    """Statistical, semantic and topic features of documents as named columns."""
    docs = stage(table(spark, folder, "documents").select("doc_id", "text"), "bundle-texts")
    bundle = features.FeatureBundle("text").fit(docs)
    combined = bundle.transform(docs).select("doc_id", "features")
    return features.vector_columns(combined, "features", bundle.names(), ["doc_id"])


@query("feature_bundle_reload")
def feature_bundle_reload(spark, folder):
    """The same features from a bundle that was saved and loaded again."""
    docs = stage(table(spark, folder, "documents").select("doc_id", "text"), "bundle-texts")
    path = scratch(spark, "bundle")
    saved.save_features(spark, features.FeatureBundle("text").fit(docs), path)
    bundle = saved.load_features(spark, path)
    combined = bundle.transform(docs).select("doc_id", "features")
    return features.vector_columns(combined, "features", bundle.names(), ["doc_id"])


def job_config():
    return jobs.JobConfig(returns="bhar0_2", alpha=1e-5)


@query("full_job")
def full_job(spark, folder):
    """Data and analysis job over the reports: the features that explain the return best."""
    done = jobs.full_job(reports(spark, folder), scratch(spark, "job"), job_config(), "reports")
    return done["top_features"]


@query("training_job")
def training_job(spark, folder):
    """Lasso and classifiers on a stored feature table, with the result files."""
    done = jobs.training_job(
        feature_vectors(spark, folder),
        "report_id",
        "bhar0_2",
        scratch(spark, "training"),
        {"names": FEATURES},
    )
    return done["classifier"]["results"]
