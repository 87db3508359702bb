"""Queries on profiles, splits, versions, files, metrics and signals."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlens.functions import metrics, sentiment, signals, text
from ledgerlens.functions.wordlists import KEYWORD_TOPICS, NEGATIVE_PHRASE_WORDS, POSITIVE_PHRASE_WORDS
from ledgerlens.operators import features, profile, split, versions
from ledgerlens.queries import sql_text as q
from ledgerlens.queries.registry import documents, query, reports, scratch, table, with_reports, with_tables
from ledgerlens.session import stage
from ledgerlens.sources import tables

METRICS = list(metrics.METRIC_PATTERNS)

METRICS_SQL = "metrics AS (SELECT report_id, " + ", ".join(
    f"nullif(regexp_extract(lower(ea_text), '{pattern}', 1), '') AS {name}"
    for name, pattern in metrics.METRIC_PATTERNS.items()
) + " FROM reports)"


@query("financial_metrics", with_reports(f"SELECT report_id, {', '.join(METRICS)} FROM metrics", METRICS_SQL))
def financial_metrics(spark, folder):
    return reports(spark, folder).select("report_id", *metrics.financial_metrics("ea_text").values())


def metric_rows(spark, folder):
    wide = reports(spark, folder).select("report_id", *metrics.financial_metrics("ea_text").values())
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])
    return wide.select("report_id", F.inline(pairs)).where("value is not null")


METRIC_ROWS_SQL = "rows AS (" + " UNION ALL ".join(
    f"SELECT report_id, '{m}' AS metric, {m} AS value FROM metrics WHERE {m} IS NOT NULL" for m in METRICS
) + ")"


@query(
    "metric_groups",
    with_reports(
        """SELECT CASE WHEN contains(metric, 'dollar') THEN 'dollar' WHEN contains(metric, 'percentage')
        THEN 'percentage' ELSE 'other' END AS kind, metric, count(*) AS n FROM rows GROUP BY ALL""",
        METRICS_SQL,
        METRIC_ROWS_SQL,
    ),
)
def metric_groups(spark, folder):
    rows = metric_rows(spark, folder)
    return rows.groupBy(metrics.metric_group("metric").alias("kind"), "metric").agg(F.count(F.lit(1)).alias("n"))


@query(
    "metric_numeric",
    with_reports(
        """SELECT label, count(*) AS n, round(avg(number), 6) AS mean, max(number) AS highest FROM (
        SELECT CASE metric WHEN 'revenue_dollar' THEN 'Revenue Dollar' WHEN 'profit_dollar' THEN 'Profit Dollar'
          WHEN 'eps_dollar' THEN 'Eps Dollar' WHEN 'growth_percentage' THEN 'Growth Percentage'
          ELSE 'Margin Percentage' END AS label,
        TRY_CAST(regexp_replace(value, '[$%BM]', '', 'g') AS DOUBLE) AS number FROM rows)
        WHERE number IS NOT NULL GROUP BY label""",
        METRICS_SQL,
        METRIC_ROWS_SQL,
    ),
)
def metric_numeric(spark, folder):
    rows = metric_rows(spark, folder).select(
        metrics.metric_label("metric").alias("label"), metrics.metric_number("value").alias("number")
    )
    return rows.where("number is not null").groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("number"), 6).alias("mean"), F.max("number").alias("highest")
    )


STATS_SQL = f"""
stats_words AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^{q.SPACE}]+') AS w FROM documents),
stats_counts AS (
  SELECT doc_id, source, len(w)::DOUBLE AS word_count, length(text)::DOUBLE AS char_count,
    (length(text) - length(replace(text, '.', '')) + 1)::DOUBLE AS sentence_count,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::DOUBLE AS letters
  FROM stats_words
),
stats AS (
  SELECT doc_id, source, word_count, char_count, sentence_count,
    CASE WHEN word_count > 0 THEN letters / word_count ELSE 0.0 END AS avg_word_length,
    word_count / sentence_count AS avg_sentence_length
  FROM stats_counts
)"""


def document_statistics(spark, folder):
    docs = documents(spark, folder).select("doc_id", "source", features.statistical_features("text").alias("s"))
    return docs.select("doc_id", "source", "s.*")


@query("stat_features", with_tables(f"SELECT doc_id, {q.rounded(features.STATISTICS)} FROM stats", STATS_SQL))
def stat_features(spark, folder):
    stats = document_statistics(spark, folder)
    return stats.select("doc_id", *[F.round(c, 6).alias(c) for c in features.STATISTICS])


@query(
    "nonzero_features",
    with_tables(
        """SELECT feature, CAST(sum(CASE WHEN value <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_with_value FROM listed
        GROUP BY feature HAVING max(abs(value)) > 0""",
        q.scores_table("documents", "doc_id", "text"),
        "listed AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {c} AS value FROM scores" for c in q.SCORES
        ) + ")",
    ),
)
def nonzero_features(spark, folder):
    """Scores that occur at all in the documents."""
    scored = documents(spark, folder).select("doc_id", sentiment.lexicon_scores("text").alias("s"))
    # The scores are read twice; storing them is cheaper than reading the texts again.
    wide = stage(scored.select("doc_id", "s.*"), "scores")
    kept = features.nonzero_columns(wide, q.SCORES)
    counts = wide.agg(*[F.count_if(F.col(c) != 0).alias(c) for c in kept])
    return counts.unpivot([], kept, "feature", "rows_with_value")


@query(
    "align_features",
    with_tables(
        "SELECT doc_id, word_count, 0.0::DOUBLE AS upper_count, char_count FROM stats", STATS_SQL
    ),
)
def align_features(spark, folder):
    """A table brought to the columns of a training table: one is missing, three are too many."""
    wide = document_statistics(spark, folder).drop("source")
    return features.align_columns(wide, ["word_count", "upper_count", "char_count"], ["doc_id"])


@query(
    "feature_join",
    with_tables(
        """SELECT doc_id, word_count AS stat_0, char_count AS stat_1, round(positive, 6) AS sem_0,
        round(negative, 6) AS sem_1 FROM stats JOIN scores USING (doc_id)""",
        STATS_SQL,
        q.scores_table("documents", "doc_id", "text"),
    ),
)
def feature_join(spark, folder):
    """Feature tables that were made apart, joined by key, with generated names."""
    stats = document_statistics(spark, folder).select("doc_id", "word_count", "char_count")
    scored = documents(spark, folder).select("doc_id", sentiment.lexicon_scores("text").alias("s"))
    joined = features.join_features({"stat": stats, "sem": scored.select("doc_id", "s.positive", "s.negative")}, "doc_id")
    names = features.feature_names({"stat": 2, "sem": 2})
    values = ["word_count", "char_count", F.round("positive", 6), F.round("negative", 6)]
    return joined.select("doc_id", *[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in zip(names, values)])


@query(
    "text_stats",
    with_tables(
        """SELECT round(avg(n), 6) AS mean_length, median(n)::DOUBLE AS median_length, min(n) AS min_length,
        max(n) AS max_length, round(stddev_samp(n), 6) AS std_length, count(*) AS total_documents,
        count(*) FILTER (n = 0) AS empty_documents FROM w""",
        f"w AS (SELECT {q.word_count('text')} AS n FROM documents)",
    ),
)
def text_stats(spark, folder):
    stats = profile.text_statistics(documents(spark, folder), "text")
    return stats.select(
        F.round("mean_length", 6).alias("mean_length"),
        "median_length",
        F.col("min_length").cast("long").alias("min_length"),
        F.col("max_length").cast("long").alias("max_length"),
        F.round("std_length", 6).alias("std_length"),
        "total_documents",
        "empty_documents",
    )


QUARTILES = ", ".join(f"round(quantile_cont(bhar0_2, {p}), 6) AS {n}" for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))


@query(
    "describe_target",
    with_reports(
        f"""SELECT count(*) AS "count", round(avg(bhar0_2), 6) AS mean, round(stddev_samp(bhar0_2), 6) AS std,
        round(min(bhar0_2), 6) AS "min", {QUARTILES}, round(max(bhar0_2), 6) AS "max" FROM reports"""
    ),
)
def describe_target(spark, folder):
    described = profile.describe(reports(spark, folder), "bhar0_2")
    return described.select("count", *[F.round(c, 6).alias(c) for c in described.columns if c != "count"])


@query(
    "box_target",
    with_tables(
        """SELECT round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
        round(min(o_totalprice) FILTER (o_totalprice >= q25 - 1.5 * (q75 - q25)), 6) AS lower_whisker,
        round(max(o_totalprice) FILTER (o_totalprice <= q75 + 1.5 * (q75 - q25)), 6) AS upper_whisker,
        count(*) FILTER (o_totalprice < q25 - 1.5 * (q75 - q25) OR o_totalprice > q75 + 1.5 * (q75 - q25)) AS outliers
        FROM orders, quartiles GROUP BY q25, q50, q75""",
        """quartiles AS (SELECT quantile_cont(o_totalprice, 0.25) AS q25, quantile_cont(o_totalprice, 0.5) AS q50,
        quantile_cont(o_totalprice, 0.75) AS q75 FROM orders)""",
    ),
)
def box_target(spark, folder):
    box = profile.box_statistics(table(spark, folder, "orders"), "o_totalprice")
    return box.select(*[F.round(c, 6).alias(c) for c in box.columns if c != "outliers"], "outliers")


# Numeric columns of the lines of orders; a tax of 0.04 is made NaN and one of 0.05 NULL, both of which are missing.
NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "tax", "skewed"]
NUMBERS_SQL = "numbers AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS name, ({value})::DOUBLE AS v FROM lineitem"
    for name, value in zip(NUMBERS, [*NUMBERS[:7], "CASE WHEN l_tax NOT IN (0.04, 0.05) THEN l_tax END",
                                     "CASE WHEN l_partkey % 3 > 0 THEN 7 ELSE l_extendedprice END"])
) + ")"


def numbers(spark, folder):
    """Lines with a column of missing values and one where two thirds of the rows have the same value."""
    tax = F.when(F.col("l_tax") == 0.04, F.lit(float("nan"))).when(F.col("l_tax") != 0.05, F.col("l_tax"))
    skewed = F.when(F.col("l_partkey") % 3 > 0, F.lit(7.0)).otherwise(F.col("l_extendedprice"))
    return table(spark, folder, "lineitem").withColumns({"tax": tax, "skewed": skewed}), {name: name for name in NUMBERS}


@query(
    "describe_numbers",
    with_tables(
        """SELECT name, count(v) AS "count", round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS "min",
        round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75,
        max(v) AS "max" FROM numbers GROUP BY name""",
        NUMBERS_SQL,
    ),
)
def describe_numbers(spark, folder):
    """All numeric columns of a table in two scans."""
    found = profile.describe_columns(*numbers(spark, folder))
    digits = {"mean": 4, "std": 4, "q25": 6, "q50": 6, "q75": 6}
    return found.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(
    "box_numbers",
    with_tables(
        """SELECT name, round(any_value(q25), 6) AS q25, round(any_value(q50), 6) AS q50, round(any_value(q75), 6) AS q75,
        min(v) FILTER (v >= q25 - 1.5 * (q75 - q25)) AS lower_whisker, max(v) FILTER (v <= q75 + 1.5 * (q75 - q25)) AS upper_whisker,
        count(*) FILTER (v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS outliers
        FROM numbers JOIN quartiles USING (name) GROUP BY name""",
        NUMBERS_SQL,
        """quartiles AS (SELECT name, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75
        FROM numbers GROUP BY name)""",
    ),
)
def box_numbers(spark, folder):
    """Box plots of all numeric columns of a table in two scans."""
    found = profile.box_columns(*numbers(spark, folder))
    return found.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q75")})


def histogram_sql(source: str, value: str, bins: int, *more: str) -> str:
    body = """SELECT g.bin, coalesce(c.n, 0) AS n FROM (SELECT CAST(unnest(range(BINS)) AS INTEGER) AS bin) g
    LEFT JOIN (SELECT bin, count(*) AS n FROM binned GROUP BY bin) c ON c.bin = g.bin""".replace("BINS", str(bins))
    binned = f"""vals AS (SELECT ({value})::DOUBLE AS v FROM {source}),
    ends AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
    binned AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) END
      AS INTEGER) AS bin FROM vals, ends)"""
    return with_tables(body, *more, binned)


@query("wordcount_hist", histogram_sql("documents", q.word_count("text"), 50))
def wordcount_hist(spark, folder):
    words = stage(documents(spark, folder).select(text.word_count("text").alias("words")), "words")
    hist = profile.histograms(words, {"words": F.col("words")}, 50)
    return hist.select("bin", "n")


@query("target_hist", histogram_sql("orders", "o_totalprice", 50))
def target_hist(spark, folder):
    hist = profile.histograms(table(spark, folder, "orders"), {"price": F.col("o_totalprice")}, 50)
    return hist.select("bin", "n")


@query(
    "score_hist",
    with_reports(
        """SELECT g.name, g.bin, coalesce(c.n, 0) AS n
        FROM (SELECT name, CAST(unnest(range(20)) AS INTEGER) AS bin FROM ends) g
        LEFT JOIN (SELECT name, bin, count(*) AS n FROM binned GROUP BY ALL) c ON c.bin = g.bin AND c.name = g.name""",
        q.scores_table("reports", "report_id", "ea_text"),
        "listed AS (" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS v FROM scores" for c in q.SCORES) + ")",
        "ends AS (SELECT name, min(v) AS lo, max(v) AS hi FROM listed GROUP BY name)",
        """binned AS (SELECT l.name, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 20)), 19) END
        AS INTEGER) AS bin FROM listed l JOIN ends e ON e.name = l.name)""",
    ),
)
def score_hist(spark, folder):
    scored = reports(spark, folder).select(sentiment.lexicon_scores("ea_text").alias("s")).select("s.*")
    return profile.histograms(stage(scored, "scores"), {c: F.col(c) for c in q.SCORES}, 20).select("name", "bin", "n")


@query(
    "dataset_overview",
    with_reports(
        """SELECT count(*) AS records, CAST(5 AS INTEGER) AS columns,
        strftime(max(report_date), '%Y-%m-%d') AS latest_date FROM reports"""
    ),
)
def dataset_overview(spark, folder):
    return profile.overview(reports(spark, folder))


@query(
    "column_kinds",
    with_reports(
        """SELECT * FROM (VALUES ('text', 'ea_text'), ('text', 'segment'), ('numeric', 'report_id'),
        ('numeric', 'bhar0_2'), ('date', 'report_date')) v(kind, name), (SELECT count(*) AS n FROM reports)"""
    ),
)
def column_kinds(spark, folder):
    """Columns by kind, with the number of rows that hold a value."""
    rows = reports(spark, folder)
    kinds = [(kind, name) for kind, names in profile.columns_by_kind(rows).items() for name in names]
    filled = rows.agg(*[F.count(name).alias(name) for _, name in kinds])
    pairs = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("name"), F.col(n).alias("n")) for k, n in kinds]
    )
    return filled.select(F.inline(pairs))


@query(
    "preview_rows",
    with_reports(
        """SELECT report_id, segment, substring(coalesce(ea_text, ''), 1, 50) AS preview FROM reports
        ORDER BY report_id LIMIT 10"""
    ),
)
def preview_rows(spark, folder):
    """First rows for display, with the start of the text."""
    rows = reports(spark, folder)
    name = profile.text_column(rows)
    shown = profile.fill_text(rows, name).select("report_id", "segment", text.preview(name, 50).alias("preview"))
    return shown.orderBy("report_id").limit(10)


@query(
    "label_share",
    with_reports(
        """SELECT segment, count(*) AS n, round(avg(CASE WHEN bhar0_2 > 0.05 THEN 1 ELSE 0 END) * 100, 6) AS share
        FROM reports GROUP BY segment"""
    ),
)
def label_share(spark, folder):
    labelled = split.add_label(reports(spark, folder), "bhar0_2")
    return labelled.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("label") * 100, 6).alias("share")
    )


SPLIT_SQL = """
labelled AS (SELECT report_id, CASE WHEN bhar0_2 > 0.05 THEN 1 ELSE 0 END AS label,
  md5('42|' || report_id::VARCHAR) AS h FROM reports),
sizes AS (SELECT label, count(*) AS size FROM labelled GROUP BY label),
t1 AS (SELECT *, ceil(sum(size) OVER () * 0.2) AS wanted FROM sizes),
t2 AS (SELECT *, size * wanted / sum(size) OVER () AS share FROM t1),
t3 AS (SELECT *, row_number() OVER (ORDER BY share - floor(share) DESC, label) AS r,
  wanted - sum(floor(share)) OVER () AS missing FROM t2),
t4 AS (SELECT label, size, floor(share) + CASE WHEN r <= missing THEN 1 ELSE 0 END AS n_test FROM t3),
v1 AS (SELECT *, size - n_test AS rest, ceil(sum(size - n_test) OVER () * 0.15) AS wanted FROM t4),
v2 AS (SELECT *, rest * wanted / sum(rest) OVER () AS share FROM v1),
v3 AS (SELECT *, row_number() OVER (ORDER BY share - floor(share) DESC, label) AS r,
  wanted - sum(floor(share)) OVER () AS missing FROM v2),
quotas AS (SELECT label, size, n_test, floor(share) + CASE WHEN r <= missing THEN 1 ELSE 0 END AS n_val FROM v3),
numbered AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) AS place FROM labelled),
parts AS (SELECT report_id, n.label, CASE WHEN place <= n_test THEN 'test'
  WHEN place <= n_test + n_val THEN 'val' ELSE 'train' END AS split FROM numbered n JOIN quotas q ON q.label = n.label)"""


def split_reports(spark, folder):
    labelled = split.add_label(reports(spark, folder), "bhar0_2").select("report_id", "label")
    return split.stratified_split(labelled, "report_id")


@query("stratified_split", with_reports("SELECT report_id, label, split FROM parts", SPLIT_SQL))
def stratified_split(spark, folder):
    return split_reports(spark, folder).select("report_id", "label", "split")


@query(
    "split_class_balance",
    with_reports(
        "SELECT split, count(*) AS n, round(avg(label) * 100, 6) AS positive_share FROM parts GROUP BY split", SPLIT_SQL
    ),
)
def split_class_balance(spark, folder):
    balance = split.class_balance(split_reports(spark, folder))
    return balance.select("split", "n", F.round("positive_share", 6).alias("positive_share"))


@query(
    "cv_folds",
    with_reports(
        """SELECT report_id, label, CAST((SELECT min(i) FROM range(5) t(i) WHERE place <= floor(size * (i + 1) / 5))
        AS INTEGER) AS fold FROM numbered2""",
        SPLIT_SQL,
        """numbered2 AS (SELECT n.report_id, n.label, n.place, s.size FROM numbered n JOIN sizes s ON s.label = n.label)""",
    ),
)
def cv_folds(spark, folder):
    labelled = split.add_label(reports(spark, folder), "bhar0_2").select("report_id", "label")
    return split.folds(labelled, "report_id", "label", 5).select("report_id", "label", "fold")


@query(
    "exact_sample",
    with_reports("SELECT report_id, segment FROM reports ORDER BY md5('42|' || report_id::VARCHAR) LIMIT 500"),
)
def exact_sample(spark, folder):
    return split.exact_sample(reports(spark, folder).select("report_id", "segment"), "report_id", 500)


HASH_COLUMNS = ["report_id", "segment", "ea_text"]
HASH_PARTS = " || ".join(
    f"coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in HASH_COLUMNS
)
HASH_SQL = f"""substring(md5(CAST(coalesce(sum(('0x' || substring(md5({HASH_PARTS}), 1, 16))::UBIGINT), 0)
  AS VARCHAR)), 1, 10)"""


@query(
    "content_hash",
    with_reports(f"SELECT segment, count(*) AS n, {HASH_SQL} AS version FROM reports GROUP BY segment"),
)
def content_hash(spark, folder):
    version = versions.fingerprint([F.col(c) for c in HASH_COLUMNS]).alias("version")
    return reports(spark, folder).groupBy("segment").agg(F.count(F.lit(1)).alias("n"), version)


REGISTRY_SQL = f"""
entries AS (
  SELECT segment AS version_id, report_date AS created_at, CAST(count(*) AS VARCHAR) AS description, {HASH_SQL} AS config
  FROM reports GROUP BY segment, report_date
)"""


def registry(spark, folder):
    """A registry with many entries per version: one for each segment and date."""
    config = versions.fingerprint([F.col(c) for c in HASH_COLUMNS]).alias("config")
    renamed = reports(spark, folder).withColumn("version_id", F.col("segment")).withColumn(
        "created_at", F.col("report_date")
    )
    grouped = renamed.groupBy("version_id", "created_at")
    return grouped.agg(F.count(F.lit(1)).cast("string").alias("description"), config)


@query(
    "version_upsert",
    with_reports(
        """SELECT version_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, description, config
        FROM entries QUALIFY row_number() OVER (PARTITION BY version_id ORDER BY created_at DESC) = 1""",
        REGISTRY_SQL,
    ),
)
def version_upsert(spark, folder):
    """The valid entry of each version."""
    newest = versions.latest_entries(registry(spark, folder))
    return newest.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "incremental_version",
    """SELECT * FROM (VALUES ('first', 4, true), ('again', 0, true), ('more', 1, true)) t(step, files_read, equal)""",
)
def incremental_version(spark, folder):
    """Versions of a growing folder: the files that each step reads, and whether the version is that of all rows."""
    path, sums = scratch(spark, f"files-{uuid.uuid4().hex}"), scratch(spark, f"sums-{uuid.uuid4().hex}")
    rows, seen, done = table(spark, folder, "orders"), 0, []
    for step, part in (("first", rows.where("o_orderkey % 5 > 0").repartition(4, "o_orderkey")), ("again", None), ("more", rows.where("o_orderkey % 5 = 0").coalesce(1))):
        if part is not None:
            part.write.mode("append").parquet(path)
        version = versions.files_version(spark, path, sums, rows.schema)
        known = spark.read.schema(versions.SUMS_SCHEMA).parquet(sums).count()
        done.append((step, known - seen, version == versions.content_version(spark.read.schema(rows.schema).parquet(path))))
        seen = known
    return spark.createDataFrame(done, "step string, files_read int, equal boolean")


@query(
    "version_latest",
    with_reports(
        "SELECT version_id FROM entries ORDER BY created_at DESC, version_id DESC LIMIT 1", REGISTRY_SQL
    ),
)
def version_latest(spark, folder):
    return versions.latest_version(registry(spark, folder))


@query(
    "version_info",
    with_reports(
        """SELECT version_id, count(*) AS entries, bool_or(version_id = 'BUILDING') AS wanted FROM entries
        GROUP BY version_id""",
        REGISTRY_SQL,
    ),
)
def version_info(spark, folder):
    """All versions with their number of entries."""
    return registry(spark, folder).groupBy("version_id").agg(
        F.count(F.lit(1)).alias("entries"), F.bool_or(F.col("version_id") == "BUILDING").alias("wanted")
    )


@query(
    "model_registry",
    with_reports(
        """SELECT 'lexicon' AS kind, version_id AS name, description, config AS version,
        strftime(created_at, '%Y-%m-%d') AS created_at FROM entries
        QUALIFY row_number() OVER (PARTITION BY version_id ORDER BY created_at DESC, config DESC) = 1""",
        REGISTRY_SQL,
    ),
)
def model_registry(spark, folder):
    """Newest version of each model; the entries come from the segments."""
    models = registry(spark, folder).select(
        F.col("version_id").alias("name"),
        F.lit("lexicon").alias("kind"),
        "description",
        F.col("config").alias("version"),
        "created_at",
    )
    return versions.available_models(models)


@query(
    "config_json",
    with_reports(
        """SELECT segment, '{"num_samples":' || count(*) || ',"first":' || min(report_id) || ',"last":'
        || max(report_id) || '}' AS config, max(report_id) AS parsed_last FROM reports GROUP BY segment"""
    ),
)
def config_json(spark, folder):
    """Run configurations as JSON text, and one value read back from it."""
    facts = reports(spark, folder).groupBy("segment").agg(
        F.count(F.lit(1)).alias("num_samples"), F.min("report_id").alias("first"), F.max("report_id").alias("last")
    )
    encoded = tables.config_json(facts, ["num_samples", "first", "last"])
    parsed = F.from_json("config", "num_samples bigint, first bigint, last bigint")["last"]
    return encoded.select("segment", "config", parsed.alias("parsed_last"))


COUNTS_SQL = "count(*) AS n, CAST(sum(length(ea_text)) AS BIGINT) AS chars, CAST(sum(report_id) AS BIGINT) AS ids"


def counted(df):
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("ea_text")).alias("chars"),
        F.sum("report_id").alias("ids"),
    ]


@query("csv_round_trip", with_reports(f"SELECT segment, {COUNTS_SQL} FROM reports GROUP BY segment"))
def csv_round_trip(spark, folder):
    """Reports written as gzip CSV and read back with a declared schema."""
    path = scratch(spark, "reports-csv")
    writer = reports(spark, folder).select("report_id", "segment", "ea_text").write.mode("overwrite")
    writer.options(**tables.CSV_OPTIONS).option("compression", "gzip").csv(path)
    read = tables.read_reports(spark, path, "report_id bigint, segment string, ea_text string")
    return read.groupBy("segment").agg(*counted(read))


BROKEN_LINES = "replace(replace(ea_text, 'e ', concat('e', chr(13), chr(10))), ', ', concat('\", \"', chr(10)))"


@query(
    "csv_parts_round_trip",
    with_reports(
        f"""SELECT segment, count(*) AS n, CAST(sum(length({BROKEN_LINES})) AS BIGINT) AS chars, min(md5({BROKEN_LINES})) AS least,
        max(md5({BROKEN_LINES})) AS most FROM reports GROUP BY segment"""
    ),
)
def csv_parts_round_trip(spark, folder):
    """Reports with line breaks and quotes in their texts, written as plain CSV and read in ranges of 64 KB."""
    path = scratch(spark, "reports-csv-parts")
    broken = reports(spark, folder).select("segment", F.expr(BROKEN_LINES).alias("ea_text"))
    broken.write.mode("overwrite").options(**tables.CSV_OPTIONS).csv(path)
    read = tables.read_reports(spark, path, "segment string, ea_text string", part_bytes=65536)
    digest = F.md5(F.col("ea_text").cast("binary"))
    return read.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("ea_text")).alias("chars"), F.min(digest).alias("least"), F.max(digest).alias("most")
    )


@query(
    "splits_round_trip",
    with_reports(
        f"""SELECT version, split, {COUNTS_SQL} FROM (SELECT 'v1' AS version, p.split, r.ea_text, r.report_id
        FROM parts p JOIN reports r ON r.report_id = p.report_id) GROUP BY ALL""",
        SPLIT_SQL,
    ),
)
def splits_round_trip(spark, folder):
    """Splits written under two versions; one of them is read back by partition."""
    path = scratch(spark, "splits")
    labelled = split.add_label(reports(spark, folder), "bhar0_2").select("report_id", "label", "ea_text")
    parts = split.stratified_split(labelled, "report_id")
    for version in ("v1", "v2"):
        tables.write_splits(parts, path, version)
    read = tables.read_splits(spark, path, "v1")
    return read.groupBy("version", "split").agg(*counted(read))


@query(
    "config_round_trip",
    with_reports(
        """SELECT 42 AS random_state, (SELECT count(*) FROM reports) AS num_samples,
        count(*) FILTER (split = 'train') AS train_size, count(*) FILTER (split = 'val') AS val_size,
        count(*) FILTER (split = 'test') AS test_size FROM parts""",
        SPLIT_SQL,
    ),
)
def config_round_trip(spark, folder):
    """A run configuration with the sizes of a split, written and read as JSON."""
    sizes = {r["split"]: r["n"] for r in split.class_balance(split_reports(spark, folder)).collect()}
    config = {
        "random_state": split.SEED,
        "test_size": split.TEST_SIZE,
        "val_size": split.VAL_SIZE,
        "num_samples": sum(sizes.values()),
        "data_splits": {f"{name}_size": n for name, n in sizes.items()},
    }
    path = scratch(spark, "config")
    tables.write_config(spark, config, path)
    read = tables.read_config(spark, path)
    return read.select("random_state", "num_samples", "data_splits.train_size", "data_splits.val_size", "data_splits.test_size")


@query("preview_newest", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 1000)")
def preview_newest(spark, folder):
    """Size of the bounded sample from the newest file of a folder."""
    path = scratch(spark, "preview")
    table(spark, folder, "orders").write.mode("overwrite").parquet(path)
    return tables.read_preview(spark, path).agg(F.count(F.lit(1)).alias("n"))


@query(
    "result_files",
    with_reports(
        "SELECT 'csv' AS format, segment, count(*) AS n FROM reports GROUP BY segment "
        "UNION ALL SELECT 'json', segment, count(*) FROM reports GROUP BY segment "
        "UNION ALL SELECT 'parquet', segment, count(*) FROM reports GROUP BY segment"
    ),
)
def result_files(spark, folder):
    """One result table written in three formats and read back."""
    result = reports(spark, folder).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    read = None
    for fmt in ("csv", "json", "parquet"):
        path = scratch(spark, f"result-{fmt}")
        tables.write_result(result, path, fmt)
        reader = spark.read.schema("segment string, n bigint").format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True)
        one = reader.load(path).select(F.lit(fmt).alias("format"), "segment", "n")
        read = one if read is None else read.unionByName(one)
    return read


def any_of(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def keyword_parts() -> str:
    parts = []
    for topic_id, (name, words) in enumerate(KEYWORD_TOPICS.items()):
        hits = " + ".join(f"contains(low, '{w}')::INTEGER" for w in words)
        label = f"{name}: {', '.join(words[:5])}"
        parts.append(f"SELECT doc_id, {topic_id} AS topic_id, '{label}' AS topic_label, {hits} AS hits FROM lowered")
    return " UNION ALL ".join(parts)


@query(
    "keyword_topics",
    with_reports(
        """SELECT doc_id, topic_id, topic_label, hits, round(least(0.95, hits * 0.15::DOUBLE), 6) AS relevance
        FROM tagged WHERE hits >= 2""",
        """lowered AS (SELECT 'd' || doc_id::VARCHAR AS doc_id, lower(text) AS low FROM documents
        UNION ALL SELECT 'r' || report_id::VARCHAR, lower(ea_text) FROM reports)""",
        f"tagged AS ({keyword_parts()})",
    ),
)
def keyword_topics(spark, folder):
    texts = documents(spark, folder).select(F.concat(F.lit("d"), F.col("doc_id")).alias("doc_id"), "text")
    more = reports(spark, folder).select(
        F.concat(F.lit("r"), F.col("report_id")).alias("doc_id"), F.col("ea_text").alias("text")
    )
    tags = texts.unionByName(more).select("doc_id", F.inline(signals.keyword_topics("text")))
    return tags.withColumn("relevance", F.round("relevance", 6))


@query(
    "insight_flags",
    with_reports(
        """SELECT report_id, CASE WHEN len(found) > 0 THEN array_to_string(found, '|')
        ELSE 'none' END AS insights FROM (
        SELECT report_id, list_filter([
          CASE WHEN contains(low, 'revenue') THEN CASE
            WHEN contains(low, 'growth') OR contains(low, 'increase') THEN 'revenue_up'
            WHEN contains(low, 'decline') OR contains(low, 'decrease') THEN 'revenue_down' END END,
          CASE WHEN contains(low, 'margin') THEN CASE
            WHEN contains(low, 'expanded') OR contains(low, 'increase') THEN 'margin_up'
            WHEN contains(low, 'contracted') OR contains(low, 'decrease') THEN 'margin_down' END END,
          CASE WHEN contains(low, 'guidance') THEN CASE
            WHEN contains(low, 'raising') OR contains(low, 'positive') THEN 'guidance_raised'
            WHEN contains(low, 'lowering') OR contains(low, 'negative') THEN 'guidance_lowered'
            ELSE 'guidance_kept' END END], lambda x: x IS NOT NULL) AS found
        FROM (SELECT report_id, lower(ea_text) AS low FROM reports))"""
    ),
)
def insight_flags(spark, folder):
    return reports(spark, folder).select(
        "report_id", F.array_join(signals.insight_flags("ea_text"), "|").alias("insights")
    )


@query(
    "sentiment_phrases",
    with_tables(
        f"""SELECT doc_id, len(good) AS positive_phrases, len(bad) AS negative_phrases,
        array_to_string(good[1:3], '|') AS first_positive, array_to_string(bad[1:3], '|') AS first_negative FROM (
        SELECT doc_id, list_filter(p, lambda s: {any_of("lower(s)", POSITIVE_PHRASE_WORDS)}) AS good,
          list_filter(p, lambda s: NOT {any_of("lower(s)", POSITIVE_PHRASE_WORDS)}
            AND {any_of("lower(s)", NEGATIVE_PHRASE_WORDS)}) AS bad
        FROM pieces)""",
        """pieces AS (SELECT doc_id, list_filter(list_transform(string_split(text, '.'),
        lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda s: length(s) >= 5) AS p
        FROM documents)""",
    ),
)
def sentiment_phrases(spark, folder):
    found = documents(spark, folder).select("doc_id", signals.sentiment_phrases("text").alias("p"))
    good, bad = F.col("p.positive_phrases"), F.col("p.negative_phrases")
    return found.select(
        "doc_id",
        F.size(good).cast("long").alias("positive_phrases"),
        F.size(bad).cast("long").alias("negative_phrases"),
        F.array_join(signals.top_phrases(good), "|").alias("first_positive"),
        F.array_join(signals.top_phrases(bad), "|").alias("first_negative"),
    )


# The scores of the made reports are small, so the bands are read on a scaled score.
BAND_SQL = "scaled AS (SELECT r.report_id, r.ea_text, s.net_sentiment * 8 AS score FROM reports r JOIN scores s ON s.report_id = r.report_id)"


def scaled_scores(spark, folder):
    scored = reports(spark, folder).select("report_id", "ea_text", sentiment.lexicon_scores("ea_text").alias("s"))
    return scored.select("report_id", "ea_text", (F.col("s.net_sentiment") * 8).alias("score"))


@query(
    "impact_bands",
    with_reports(
        """SELECT report_id, CASE WHEN score > 0.5 THEN 'strong_up' WHEN score > 0.2 THEN 'slight_up'
          WHEN score < -0.5 THEN 'strong_down' WHEN score < -0.2 THEN 'slight_down' ELSE 'neutral' END AS band
        FROM scaled""",
        q.scores_table("reports", "report_id", "ea_text"),
        BAND_SQL,
    ),
)
def impact_bands(spark, folder):
    return scaled_scores(spark, folder).select("report_id", signals.score_band("score").alias("band"))


@query(
    "key_factors",
    with_reports(
        """SELECT report_id, array_to_string(list_filter([
          CASE WHEN contains(low, 'growth') OR contains(low, 'increase') THEN 'growth' END,
          CASE WHEN contains(low, 'decline') OR contains(low, 'decrease') THEN 'decline' END,
          CASE WHEN contains(low, 'guidance') THEN CASE WHEN contains(low, 'raising') THEN 'guidance_raised'
            WHEN contains(low, 'lowering') THEN 'guidance_lowered' ELSE 'guidance_kept' END END,
          CASE WHEN contains(low, 'margin') THEN CASE WHEN contains(low, 'expanded') THEN 'margin_up'
            WHEN contains(low, 'contracted') THEN 'margin_down' END END], lambda x: x IS NOT NULL), '|') AS factors
        FROM (SELECT report_id, lower(ea_text) AS low FROM reports)"""
    ),
)
def key_factors(spark, folder):
    return reports(spark, folder).select("report_id", F.array_join(signals.named_factors("ea_text"), "|").alias("factors"))


@query(
    "polarity_class",
    with_reports(
        """SELECT CASE WHEN net_sentiment > 0.1 THEN 'Positive' WHEN net_sentiment < -0.1 THEN 'Negative'
          ELSE 'Neutral' END AS polarity, CASE WHEN net_sentiment * 8 > 0.2 THEN 'Positive'
          WHEN net_sentiment * 8 < -0.2 THEN 'Negative' ELSE 'Neutral' END AS summary, count(*) AS n
        FROM scores GROUP BY ALL""",
        q.scores_table("reports", "report_id", "ea_text"),
    ),
)
def polarity_class(spark, folder):
    scored = reports(spark, folder).select(sentiment.lexicon_scores("ea_text")["net_sentiment"].alias("net"))
    classes = scored.select(
        sentiment.sentiment_class("net").alias("polarity"),
        sentiment.sentiment_class(F.col("net") * 8, sentiment.SUMMARY_LIMIT).alias("summary"),
    )
    return classes.groupBy("polarity", "summary").agg(F.count(F.lit(1)).alias("n"))


@query(
    "normalised_polarity",
    with_tables(
        """SELECT doc_id, round(CASE WHEN t > 0 THEN pos / t ELSE pos END, 6) AS positive,
        round(CASE WHEN t > 0 THEN neu / t ELSE neu END, 6) AS neutral,
        round(CASE WHEN t > 0 THEN neg / t ELSE neg END, 6) AS negative
        FROM (SELECT *, pos + neu + neg AS t FROM (SELECT doc_id,
          CASE WHEN flat AND net_sentiment > 0 THEN net_sentiment ELSE positive END AS pos,
          CASE WHEN flat AND net_sentiment < 0 THEN -net_sentiment ELSE negative END AS neg,
          CASE WHEN flat AND net_sentiment = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS neu
          FROM (SELECT *, positive = 0 AND negative = 0 AS flat FROM scores)))""",
        q.scores_table("documents", "doc_id", "text"),
    ),
)
def normalised_polarity(spark, folder):
    scored = documents(spark, folder).select("doc_id", sentiment.lexicon_scores("text").alias("s"))
    shares = sentiment.normalised_polarity(
        F.col("s.positive"), F.lit(0.0), F.col("s.negative"), F.col("s.net_sentiment")
    )
    parts = scored.select("doc_id", shares.alias("p")).select("doc_id", "p.*")
    return parts.select("doc_id", *[F.round(c, 6).alias(c) for c in ("positive", "neutral", "negative")])
