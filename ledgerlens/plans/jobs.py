"""Whole jobs: prepare data, analyse it, train models, score texts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import metrics, sentiment, signals
from ledgerlens.functions.text import clean_sentences, word_count
from ledgerlens.operators import features, models, profile, split, topics, versions
from ledgerlens.operators.vectorize import MAX_FEATURES, fit_vocabulary, vectorizer
from ledgerlens.session import spread, stage
from ledgerlens.sources import models as saved
from ledgerlens.sources import tables


@dataclass
class JobConfig:
    """Settings of the data and analysis jobs.

    Input that is not columnar is first copied to parquet, so that the passes of the split read keys and labels only. Set
    ``columnar_input`` for tables that are parquet already.
    """

    key: str = "report_id"
    returns: str = "BHAR0_2"
    threshold: float = split.RETURN_THRESHOLD
    test_size: float = split.TEST_SIZE
    val_size: float = split.VAL_SIZE
    seed: int = split.SEED
    embedding: str = "tfidf"
    topic_method: str = "lda"
    topics: int = 40
    max_features: int = MAX_FEATURES
    semantic_components: int = features.SEMANTIC_COMPONENTS
    tune_topics: list[int] = field(default_factory=list)
    tune_sample: int | None = None  # all rows, unless the caller asks for a sample
    alpha: float = models.JOB_ALPHA
    top: int = 10
    columnar_input: bool = False
    financial_hook: Callable[[DataFrame], DataFrame] = lambda df: df


def prepare(df: DataFrame, config: JobConfig) -> DataFrame:
    """Clean text, apply the hook for financial columns and add the label (H8, B5, K5, B3); one lazy map."""
    text = profile.text_column(df)
    cleaned = df.withColumn("clean_sent", clean_sentences(text))
    return split.add_label(cleaned.transform(config.financial_hook), config.returns, config.threshold)


def data_job(reports: DataFrame, folder: str, config: JobConfig, source: str = "") -> dict:
    """Load, clean, profile, label, split, save and register.

    Texts are cleaned once, in the map that writes the splits: the split itself reads keys and labels only, and the
    statistics come from the written table.
    """
    spark = reports.sparkSession
    if not config.columnar_input:
        # Files that can't be split come as one partition each; cleaning is spread over the cores.
        reports = stage(spread(reports, config.key), "reports")
    version = versions.content_version(reports)
    prepared = prepare(reports, config)
    settings = (config.test_size, config.val_size, config.seed)
    labelled = "label" in prepared.columns
    if labelled:
        parts = split.stratified_split(prepared, config.key, "label", *settings)
    else:
        parts = split.random_split(prepared, config.key, *settings)
    tables.write_splits(parts, f"{folder}/splits", version)
    saved = tables.read_splits(spark, f"{folder}/splits", version)
    statistics = profile.text_statistics(saved, "clean_sent").first()
    balance = {r["split"]: r for r in split.class_balance(saved).collect()}
    sizes = {name: balance[name]["n"] if name in balance else 0 for name in ("train", "val", "test")}
    record = {
        "data_path": source,
        "random_state": config.seed,
        "test_size": config.test_size,
        "val_size": config.val_size,
        "processing_date": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
        "data_version": version,
        "num_samples": sum(sizes.values()),
        "data_splits": {
            **{f"{name}_size": n for name, n in sizes.items()},
            "target_column": config.returns if labelled else None,
            "stratify_column": "label" if labelled else None,
        },
    }
    tables.write_config(spark, record, f"{folder}/configs/{version}")
    text = tables.read_config(spark, f"{folder}/configs/{version}").select(F.to_json(F.struct("*"))).first()[0]
    versions.VersionRegistry(spark, f"{folder}/versions").register(version, text, "prepared reports")
    return {"version": version, "statistics": statistics.asDict(), "config": record, "splits": saved}


def analysis_job(spark: SparkSession, folder: str, config: JobConfig, version: str | None = None) -> dict:
    """Embeddings, sentiment, topics, features and an explaining regression on the training part.

    Texts are read twice: for the vocabulary, and in the map that writes sentiment, length features and the count matrix.
    Topics, embeddings and features follow from that written table. Every result and every fitted model is saved under
    ``folder/analysis/<version>/<topic method>-<embedding>``. Without returns there is no regression, as the data job allows such a table.
    """
    version = version or versions.VersionRegistry(spark, f"{folder}/versions").latest()
    if version is None:
        raise ValueError("no registered version; run the data job first")
    out = f"{folder}/analysis/{version}/{config.topic_method}-{config.embedding}"
    splits = tables.read_splits(spark, f"{folder}/splits", version)
    text = profile.text_column(splits, ("clean_sent", "ea_text"))
    train = profile.fill_text(splits.where("split = 'train'"), text)
    extra = [c for c in ("label", config.returns) if c in splits.columns]
    vocabulary = fit_vocabulary(train, text, config.max_features)
    counter = vectorizer(vocabulary, text, output="dtm")
    mapped = counter.transform(train.select(config.key, *extra, text, sentiment.analyze(text).alias("s")))
    mapped = features.add_statistical_vector(mapped, text)
    mapped.write.mode("overwrite").parquet(f"{out}/vectors")
    vectors = spark.read.parquet(f"{out}/vectors")
    scored = vectors.select(config.key, *extra, "s.*")
    tables.write_result(scored, f"{out}/sentiment", "parquet")
    embedder = features.Embedder(config.embedding, config.max_features).fit(train, text, vocabulary)
    saved.save_embedder(spark, embedder, f"{out}/embedder")
    tables.write_result(embedder.transform(train.select(config.key, text)).drop(text), f"{out}/embeddings", "parquet")
    count, tuning = config.topics, None
    if config.tune_topics:
        sample = vectors
        if config.tune_sample is not None:
            sample = stage(split.exact_sample(vectors, config.key, config.tune_sample, config.seed), "tuning")
        terms = topics.matrix_terms("dtm", counter.vocabulary)
        tuning = topics.tune_topics(sample, "dtm", counter.vocabulary, sample, terms, config.tune_topics)
        tables.write_result(tuning, f"{out}/tuning")
        count = topics.best_topic_count(tuning).first()["topics"]
    if config.topic_method == "nmf":
        topic_model = topics.fit_nmf(vectors, "dtm", count)
        weights = topics.topic_word_weights(spark, topic_model.components.T, counter.vocabulary)
        distribution = topic_model.transform(vectors.select(config.key, "dtm"), "dtm", "topic_weights")
    else:
        topic_model = topics.fit_lda(vectors, "dtm", count)
        weights = topics.topic_word_weights(spark, topic_model.topics_matrix(), counter.vocabulary)
        distribution = topic_model.transform(vectors.select(config.key, "dtm"))
        distribution = distribution.withColumn("topic_weights", vector_to_array("topic_vector"))
    saved.save_topic_model(spark, topic_model, counter.vocabulary, f"{out}/topic_model")
    tables.write_result(distribution.select(config.key, "topic_weights"), f"{out}/topic_distributions", "parquet")
    top = topics.top_words(weights)
    lines = tables.topic_word_lines(topics.word_lists(top))
    tables.write_result(lines.select("line"), f"{out}/topic_words", "text")
    tables.write_result(lines.select("json"), f"{out}/topic_words_json", "text")
    bundle = features.FeatureBundle(
        text, config.max_features, config.semantic_components, count, topic_iterations=topics.LDA_FEATURE_ITER
    ).fit(train, vocabulary, vectors, topic_model if config.topic_method != "nmf" else None)
    saved.save_features(spark, bundle, f"{out}/feature_bundle")
    bundled = bundle.from_matrix(vectors)
    tables.write_result(bundled.select(config.key, *extra, "features"), f"{out}/features", "parquet")
    result = {
        "version": version,
        "folder": out,
        "embedder": embedder,
        "sentiment": spark.read.parquet(f"{out}/sentiment"),
        "topic_model": topic_model,
        "topic_words": top,
        "tuning": tuning,
        "features": spark.read.parquet(f"{out}/features"),
    }
    if config.returns not in extra:
        return result
    usable = result["features"].where(F.col(config.returns).isNotNull() & ~F.isnan(config.returns))
    fitted = models.lasso(config.alpha, label=config.returns).fit(usable)
    fitted.write().overwrite().save(f"{out}/lasso")
    importance = models.coefficient_table(spark, fitted.coefficients, bundle.names())
    tables.write_result(importance, f"{out}/coefficients")
    return result | {"lasso": fitted, "importance": importance, "top_features": models.top_features(importance, config.top)}


def full_job(reports: DataFrame, folder: str, config: JobConfig, source: str = "") -> dict:
    """Data job and analysis job on the same version."""
    prepared = data_job(reports, folder, config, source)
    return {**prepared, **analysis_job(reports.sparkSession, folder, config, prepared["version"])}


def training_job(table: DataFrame, key: str, returns: str, folder: str, lasso_config=None, class_config=None) -> dict:
    """Lasso and classifiers on a stored feature table, with their result tables."""
    trained = models.train_model(table, key, returns, "all", lasso_config, class_config)
    tables.write_result(trained["lasso"]["coefficients"], f"{folder}/lasso_coefficients")
    tables.write_result(trained["lasso"]["nonzero"], f"{folder}/nonzero_lasso_coefficients")
    tables.write_result(trained["classifier"]["results"], f"{folder}/classifier_results", "json")
    trained["lasso"]["model"].write().overwrite().save(f"{folder}/lasso")
    for kind, model in trained["classifier"]["models"].items():
        saved.save_classifier(table.sparkSession, model, f"{folder}/classifiers/{kind}")
    best = trained["classifier"]["models"][trained["classifier"]["best"]]
    saved.save_classifier(table.sparkSession, best, f"{folder}/best_classifier")
    return trained


def score_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Everything that can be said about a text without a fitted model, for a whole table in one map."""
    col = F.col(text)
    scored = df.select(
        key,
        word_count(col).alias("word_count"),
        sentiment.analyze(col).alias("s"),
        col.alias("_text"),
        *metrics.financial_metrics(col).values(),
    )
    net = F.col("s.net_sentiment")
    return scored.select(
        key,
        "word_count",
        "s.*",
        sentiment.sentiment_class(net, sentiment.SUMMARY_LIMIT).alias("summary_class"),
        signals.score_band(net).alias("band"),
        *metrics.METRIC_PATTERNS,
        signals.keyword_topics("_text").alias("keyword_topics"),
        signals.insight_flags("_text").alias("insights"),
        signals.named_factors("_text").alias("factors"),
    )
