import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from ledgerlens.operators.versions import VersionRegistry
from ledgerlens.plans import jobs
from ledgerlens.queries.registry import reports
from ledgerlens.sources import models as saved
from ledgerlens.sources import tables
from tests.conftest import values


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    rows = [('Line one\nline "two", end ', 0.1), ("", None), (" plain", -0.2)]
    df = spark.createDataFrame(rows, tables.REPORT_SCHEMA)
    df.write.options(**tables.CSV_OPTIONS).option("compression", "gzip").csv(str(tmp_path / "r"))
    read = tables.read_reports(spark, str(tmp_path / "r"), partitions=3)
    assert read.rdd.getNumPartitions() == 3
    # An empty text is read as missing.
    expected = [(t or None, x) for t, x in rows]
    assert sorted(values(read), key=str) == sorted(expected, key=str)


def test_registry(spark, tmp_path):
    registry = VersionRegistry(spark, str(tmp_path / "versions"))
    assert registry.latest() is None and registry.info("a") is None
    registry.register("a", "{}", "first")
    registry.register("b", "{}", "second")
    registry.register("a", '{"x": 1}', "third")
    assert registry.latest() == "a"
    assert registry.info("a")["description"] == "third"
    assert sorted(r[0] for r in registry.list().collect()) == ["a", "b"]


def test_writing_a_version_again_replaces_only_it(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, "train"), (2, "test")], "k int, split string")
    tables.write_splits(df, path, "v1")
    tables.write_splits(df, path, "v2")
    tables.write_splits(df.where("k = 1"), path, "v2")
    assert tables.read_splits(spark, path, "v1").count() == 2
    plan = tables.read_splits(spark, path, "v1").where("split = 'train'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(version" in plan


def test_preview_of_the_newest_file(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1500).coalesce(1).write.parquet(path)
    assert tables.read_preview(spark, path).count() == 1000
    assert tables.read_preview(spark, path, preferred=path).count() == 1500
    assert tables.read_preview(spark, path, preferred=str(tmp_path / "none"), rows=10).count() == 10


@pytest.fixture(scope="module")
def job(spark, data, tmp_path_factory):
    config = jobs.JobConfig(
        returns="bhar0_2", topics=3, max_features=60, semantic_components=3, alpha=1e-6, tune_topics=[2, 3], tune_sample=100
    )
    folder = str(tmp_path_factory.mktemp("job"))
    return folder, config, jobs.full_job(reports(spark, data), folder, config, "orders")


def test_data_job_saves_and_registers(spark, data, job):
    folder, config, done = job
    sizes = done["config"]["data_splits"]
    n = reports(spark, data).count()
    assert sizes["train_size"] + sizes["val_size"] + sizes["test_size"] == n
    assert VersionRegistry(spark, f"{folder}/versions").latest() == done["version"]
    read = tables.read_config(spark, f"{folder}/configs/{done['version']}").first()
    assert read["num_samples"] == n and read["data_splits"]["stratify_column"] == "label"
    assert set(done["splits"].columns) >= {"clean_sent", "label", "split", "version"}


def test_analysis_job_ranks_named_features(job):
    _, _, done = job
    names = [r["feature"] for r in done["top_features"].collect()]
    assert len(names) == 10 and all(n.split("_")[0] in ("stat", "sem", "topic") for n in names)
    assert done["tuning"].count() == 2
    assert done["topic_words"].count() > 0 and done["sentiment"].count() > 0


def test_analysis_job_saves_every_result(spark, job):
    _, config, done = job
    out, n = done["folder"], done["config"]["data_splits"]["train_size"]
    for name in ("vectors", "sentiment", "embeddings", "topic_distributions", "features"):
        assert spark.read.parquet(f"{out}/{name}").count() == n
    model, vocabulary = saved.load_topic_model(spark, f"{out}/topic_model")
    assert model.vocabulary_size() == len(vocabulary) and saved.load_embedder(spark, f"{out}/embedder").text == "clean_sent"
    assert spark.read.text(f"{out}/topic_words").count() == done["tuning"].agg(F.max_by("topics", "mean_umass")).first()[0]
    assert spark.read.option("header", True).csv(f"{out}/tuning").count() == 2
    weights = spark.read.parquet(f"{out}/topic_distributions")
    assert weights.where(F.abs(F.aggregate("topic_weights", F.lit(0.0), lambda a, b: a + b) - 1) > 1e-6).count() == 0
    assert LinearRegressionModel.load(f"{out}/lasso").coefficients == done["lasso"].coefficients


def test_nmf_job_on_a_saved_version(spark, job):
    folder, config, done = job
    from dataclasses import replace

    other = replace(config, topic_method="nmf", tune_topics=[], embedding="count")
    again = jobs.analysis_job(spark, folder, other)
    assert again["version"] == done["version"]
    assert again["topic_words"].select("topic").distinct().count() == 3


def test_training_job_writes_its_results(spark, job, tmp_path):
    _, _, done = job
    folder = str(tmp_path / "t")
    spaces = {"RandomForest": {"trees": [3], "depth": [2]}}
    trained = jobs.training_job(
        done["features"], "report_id", "bhar0_2", folder, {"alphas": 2, "k": 2}, {"n_iter": 1, "k": 2, "spaces": spaces}
    )
    assert trained["classifier"]["best"] == "RandomForest"
    assert RandomForestClassificationModel.load(f"{folder}/classifiers/RandomForest").getNumTrees == 3
    assert LinearRegressionModel.load(f"{folder}/lasso").numFeatures == trained["lasso"]["model"].numFeatures
    assert spark.read.option("header", True).csv(f"{folder}/lasso_coefficients").count() == 5 + 3 + done["topic_model"].weights.shape[0]
    assert spark.read.json(f"{folder}/classifier_results").count() == 1


def test_scoring_is_one_map(spark, data):
    scored = jobs.score_texts(reports(spark, data), "report_id", "ea_text")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEval" not in plan
    assert scored.where(F.col("positive") > 0).count() > 0


def test_columns_work_on_streams_unchanged(spark, data, tmp_path):
    from ledgerlens.functions.sentiment import lexicon_scores

    source = str(tmp_path / "in")
    reports(spark, data).select("report_id", "ea_text").write.parquet(source)
    stream = spark.readStream.schema("report_id long, ea_text string").parquet(source)
    scored = stream.select("report_id", lexicon_scores("ea_text")["positive"].alias("p"))
    run = scored.writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert spark.table("scored").count() == reports(spark, data).count()


def test_data_job_without_returns(spark, data, tmp_path):
    texts = reports(spark, data).select("report_id", "ea_text")
    done = jobs.data_job(texts, str(tmp_path / "d"), jobs.JobConfig(returns="bhar0_2"))
    sizes = done["config"]["data_splits"]
    assert sizes["stratify_column"] is None
    config = jobs.JobConfig(returns="bhar0_2", topics=2, max_features=50, semantic_components=2)
    analysed = jobs.analysis_job(spark, str(tmp_path / "d"), config)
    assert analysed["features"].count() == sizes["train_size"] and "lasso" not in analysed
    assert sizes["train_size"] + sizes["val_size"] + sizes["test_size"] == texts.count()
