"""Queries on sentiment and text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import sentiment, text
from ledgerlens.functions.wordlists import FINANCE_STOP_WORDS, LEXICON, STOP_WORDS
from ledgerlens.operators import lexicon, phrases, vectorize
from ledgerlens.queries import sql_text as q
from ledgerlens.queries.registry import documents, query, reports, table, with_reports, with_tables

SCORES = sentiment.SCORES


def rounded(df, keys, columns=SCORES, digits=6):
    return df.select(*keys, *[F.round(c, digits).alias(c) for c in columns])


@query(
    "lexicon_sentiment_by_segment",
    with_reports(
        f"""SELECT segment, count(*) AS n,
        {", ".join(f"round(avg({c}), 6) AS {c}" for c in SCORES)} FROM scores GROUP BY segment""",
        q.scores_table("reports", "report_id", "ea_text", keep=", segment"),
    ),
)
def lexicon_sentiment_by_segment(spark, folder):
    scored = reports(spark, folder).select("segment", sentiment.lexicon_scores("ea_text").alias("s"))
    means = [F.round(F.avg(F.col("s")[c]), 6).alias(c) for c in SCORES]
    return scored.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), *means)


@query(
    "lexicon_sentiment_rows",
    with_reports(
        f"SELECT report_id, {q.rounded(SCORES)} FROM scores",
        q.scores_table("reports", "report_id", "ea_text"),
    ),
)
def lexicon_sentiment_rows(spark, folder):
    scored = reports(spark, folder).select("report_id", sentiment.lexicon_scores("ea_text").alias("s"))
    return rounded(scored.select("report_id", "s.*"), ["report_id"])


@query(
    "lexicon_sentiment_documents",
    with_tables(
        f"SELECT doc_id, {q.rounded(SCORES)} FROM scores",
        q.scores_table("documents", "doc_id", "text"),
    ),
)
def lexicon_sentiment_documents(spark, folder):
    """The lexicon as a table that is joined, on Unicode text of any length."""
    docs = documents(spark, folder)
    scored = lexicon.score_with_lexicon_table(docs, "doc_id", "text", lexicon.lexicon_table(spark))
    return rounded(scored, ["doc_id"])


# Every word of the documents and a name for each line of an order; the length of a word gives its category.
LARGE_LEXICON_SQL = f"""
lexicon AS (
  SELECT term, CASE length(term) % 5 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'uncertainty'
    WHEN 3 THEN 'litigious' END AS category
  FROM (SELECT DISTINCT unnest({q.words('text')}) AS term FROM documents
    UNION SELECT DISTINCT 'o_' || l_orderkey || '_' || l_linenumber FROM lineitem)
),
hits AS (
  SELECT doc_id, category FROM (SELECT doc_id, unnest({q.words('text')}) AS term FROM documents) t JOIN lexicon USING (term)
),
sums AS (SELECT d.doc_id, greatest(len({q.words('text')}), 1)::DOUBLE AS total, """ + ", ".join(
    f"(SELECT count(*) FROM hits h WHERE h.doc_id = d.doc_id AND category = '{c}')::DOUBLE AS n_{c}" for c in LEXICON
) + " FROM documents d)"


@query(
    "lexicon_sentiment_large_table",
    with_tables(
        f"SELECT doc_id, {q.rounded(SCORES)} FROM scores",
        LARGE_LEXICON_SQL,
        "scores AS (SELECT doc_id, " + ", ".join(f"n_{c} / total AS {c}" for c in LEXICON)
        + ", (n_positive - n_negative) / total AS net_sentiment, n_positive / (n_negative + 1) AS sentiment_ratio FROM sums)",
    ),
)
def lexicon_sentiment_large_table(spark, folder):
    """A lexicon that is too large to broadcast: frequent terms are counted in their row, the others joined by shuffle."""
    docs = documents(spark, folder)
    words = docs.select(F.explode(text.word_tokens("text")).alias("term"))
    lines = table(spark, folder, "lineitem").select(F.concat_ws("_", F.lit("o"), "l_orderkey", "l_linenumber").alias("term"))
    terms = words.union(lines).distinct()
    names = F.array(*[F.lit(c) for c in ("positive", "negative", "uncertainty", "litigious")])
    terms = terms.select("term", F.get(names, F.length("term") % 5).alias("category")).where("category is not null")
    return rounded(lexicon.score_with_lexicon_table(docs, "doc_id", "text", terms), ["doc_id"])


VOCABULARY_SQL = f"""
tokens AS (SELECT report_id, {q.vocabulary('ea_text')} AS t FROM reports),
grams AS (
  SELECT report_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM tokens
),
cells AS (SELECT report_id, term, count(*) AS tf FROM grams GROUP BY ALL),
vocabulary AS (
  SELECT term FROM cells GROUP BY term HAVING count(*) <= 0.95 * (SELECT count(*) FROM reports)
  ORDER BY sum(tf) DESC, term LIMIT {vectorize.MAX_FEATURES}
),
kept AS (SELECT cells.* FROM cells JOIN vocabulary USING (term))"""


@query(
    "sentiment_from_counts",
    with_reports(
        f"SELECT report_id, {q.rounded(SCORES)} FROM scores",
        VOCABULARY_SQL,
        "sums AS (SELECT r.report_id, greatest(coalesce(sum(tf), 0), 1)::DOUBLE AS total, "
        + ", ".join(
            f"coalesce(sum(tf) FILTER (term IN ({q.quoted(terms)})), 0)::DOUBLE AS n_{c}"
            for c, terms in LEXICON.items()
        )
        + " FROM reports r LEFT JOIN kept k ON r.report_id = k.report_id GROUP BY r.report_id)",
        "scores AS (SELECT report_id, "
        + ", ".join(f"n_{c} / total AS {c}" for c in LEXICON)
        + ", (n_positive - n_negative) / total AS net_sentiment, n_positive / (n_negative + 1) AS sentiment_ratio"
        + " FROM sums)",
    ),
)
def sentiment_from_counts(spark, folder):
    """Scores from the rows of a count matrix, without tokenising again."""
    texts = reports(spark, folder).select("report_id", "ea_text")
    counter = vectorize.fit_vectorizer(texts, "ea_text")
    scored = lexicon.score_vectors(counter.transform(texts), "report_id", "vector", counter.vocabulary)
    return rounded(scored, ["report_id"])


# Pairs of neighbouring words of the benchmark; the length of a pair gives its topic.
PAIRS_SQL = f"""
pairs AS (
  SELECT DISTINCT pair AS phrase, (length(pair) % 7)::VARCHAR AS category
  FROM (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pair
    FROM (SELECT {q.words('text')} AS w FROM benchmark))
)"""


@query(
    "phrase_table_topics",
    with_tables(
        """SELECT doc_id, category, count(*) AS hits, round(least(0.95, count(*) * 0.15)::DOUBLE, 6) AS relevance
        FROM documents JOIN pairs ON contains(lower(text), phrase) GROUP BY doc_id, category HAVING count(*) >= 2""",
        PAIRS_SQL,
    ),
)
def phrase_table_topics(spark, folder):
    """Topics from a table of many phrases, all of which are found in one walk over a text."""
    words = table(spark, folder, "benchmark").select(text.word_tokens("text").alias("w"))
    near = F.transform(F.sequence(F.lit(2), F.size("w")), lambda i: F.concat_ws(" ", F.get("w", i - 2), F.get("w", i - 1)))
    pairs = words.where(F.size("w") > 1).select(F.explode(near).alias("phrase")).distinct()
    pairs = pairs.select("phrase", (F.length("phrase") % 7).cast("string").alias("category"))
    found = phrases.phrase_topics(documents(spark, folder), "doc_id", "text", pairs)
    return found.withColumn("relevance", F.round("relevance", 6))


MODEL_POSITIVE = "CASE WHEN ea_text LIKE '%growth%' THEN 0.7 WHEN ea_text LIKE '%decline%' THEN 0.1 END"
MODEL_NEGATIVE = "CASE WHEN ea_text LIKE '%growth%' THEN 0.2 WHEN ea_text LIKE '%decline%' THEN 0.6 END"


@query(
    "sentiment_combined",
    with_reports(
        f"SELECT report_id, {q.rounded(SCORES)} FROM merged",
        q.scores_table("reports", "report_id", "ea_text", keep=", ea_text"),
        f"model AS (SELECT *, {MODEL_POSITIVE} AS mp, {MODEL_NEGATIVE} AS mn FROM scores)",
        """merged AS (SELECT report_id, coalesce(mp, positive) AS positive, coalesce(mn, negative) AS negative,
        uncertainty, litigious, coalesce(mp - mn, net_sentiment) AS net_sentiment,
        coalesce(mp / (mn + 0.001), sentiment_ratio) AS sentiment_ratio FROM model)""",
    ),
)
def sentiment_combined(spark, folder):
    """A stand-in model that answers for some texts only; the lexicon fills in for the rest."""
    texts = reports(spark, folder)
    growth, decline = F.col("ea_text").contains("growth"), F.col("ea_text").contains("decline")
    model = sentiment.model_scores(
        F.when(growth, 0.7).when(decline, 0.1), F.when(growth, 0.2).when(decline, 0.6)
    )
    both = texts.select("report_id", sentiment.lexicon_scores("ea_text").alias("lex"), model.alias("model"))
    merged = both.select("report_id", sentiment.combine_scores(F.col("lex"), F.col("model")).alias("s"))
    return rounded(merged.select("report_id", "s.*"), ["report_id"])


@query(
    "sentiment_blank_default",
    with_tables(
        f"""SELECT doc_id, {", ".join(
            f"round(CASE WHEN blank THEN {default} ELSE {c} END, 6) AS {c}"
            for c, default in zip(SCORES, ["0", "0", "NULL", "NULL", "0", "1"])
        )} FROM scores""",
        "texts AS (SELECT doc_id, text AS t FROM documents UNION ALL SELECT -1 - doc_id, ' ' || chr(9) FROM documents)",
        "flagged AS (SELECT *, trim(regexp_replace(t, '\\s', '', 'g')) = '' AS blank FROM texts)",
        q.scores_table("flagged", "doc_id", "t", keep=", blank"),
    ),
)
def sentiment_blank_default(spark, folder):
    docs = documents(spark, folder)
    blank = docs.select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(" \t").alias("t"))
    texts = docs.select("doc_id", F.col("text").alias("t")).unionByName(blank)
    scored = texts.select("doc_id", sentiment.analyze("t").alias("s"))
    return rounded(scored.select("doc_id", "s.*"), ["doc_id"])


@query(
    "sentiment_enrich_prefixed",
    with_reports(
        "SELECT report_id, segment, "
        + ", ".join(f"round({c}, 6) AS sentiment_{c}" for c in SCORES)
        + " FROM scores",
        q.scores_table("reports", "report_id", "ea_text", keep=", segment"),
    ),
)
def sentiment_enrich_prefixed(spark, folder):
    enriched = lexicon.enrich(reports(spark, folder).select("report_id", "segment", "ea_text"), "ea_text")
    return rounded(enriched, ["report_id", "segment"], [f"sentiment_{c}" for c in SCORES])


@query(
    "sentiment_attach_scores",
    with_reports(
        """SELECT r.report_id, r.segment, round(s.net_sentiment, 6) AS sentiment_net_sentiment
        FROM reports r LEFT JOIN scores s USING (report_id)""",
        q.scores_table("reports", "report_id", "ea_text"),
    ),
)
def sentiment_attach_scores(spark, folder):
    """Scores stored by another job, attached by key."""
    texts = reports(spark, folder)
    scores = texts.select("report_id", sentiment.lexicon_scores("ea_text").alias("s")).select(
        "report_id", "s.net_sentiment"
    )
    joined = lexicon.attach_scores(texts.select("report_id", "segment"), scores, "report_id")
    return rounded(joined, ["report_id", "segment"], ["sentiment_net_sentiment"])


@query(
    "sentiment_top_dimensions",
    with_reports(
        """SELECT report_id, CAST(row_number() OVER (
          PARTITION BY report_id ORDER BY abs(score) DESC, dimension) AS INTEGER) AS rank,
        dimension, round(score, 6) AS score FROM listed""",
        q.scores_table("reports", "report_id", "ea_text"),
        "listed AS (" + " UNION ALL ".join(
            f"SELECT report_id, '{c}' AS dimension, {c} AS score FROM scores" for c in SCORES
        ) + ")",
    ),
)
def sentiment_top_dimensions(spark, folder):
    scored = reports(spark, folder).select("report_id", sentiment.lexicon_scores("ea_text").alias("s"))
    return rounded(
        lexicon.sentiment_rows(scored.select("report_id", "s.*"), "report_id"),
        ["report_id", "rank", "dimension"],
        ["score"],
    )


@query(
    "replace_numbers",
    with_reports(f"SELECT report_id, {q.replaced_numbers('ea_text')} AS replaced FROM reports"),
)
def replace_numbers(spark, folder):
    return reports(spark, folder).select("report_id", text.replace_financial_numbers("ea_text").alias("replaced"))


@query("clean_text", f"SELECT doc_id, {q.cleaned('text')} AS cleaned FROM documents")
def clean_text(spark, folder):
    return documents(spark, folder).select("doc_id", text.clean_text("text").alias("cleaned"))


@query("clean_sentences", f"SELECT doc_id, {q.cleaned_sentences('text')} AS clean_sent FROM documents")
def clean_sentences(spark, folder):
    return documents(spark, folder).select("doc_id", text.clean_sentences("text").alias("clean_sent"))


@query(
    "clean_sentences_reports",
    with_reports(f"SELECT report_id, {q.cleaned_sentences('ea_text')} AS clean_sent FROM reports"),
)
def clean_sentences_reports(spark, folder):
    return reports(spark, folder).select("report_id", text.clean_sentences("ea_text").alias("clean_sent"))


@query(
    "filter_sentences",
    with_reports(
        f"""SELECT 'report' AS kind, report_id AS id, {q.filtered('ea_text')} AS kept FROM reports
        UNION ALL SELECT 'document', doc_id, {q.filtered('text')} FROM documents"""
    ),
)
def filter_sentences(spark, folder):
    rows = reports(spark, folder).select(
        F.lit("report").alias("kind"), F.col("report_id").alias("id"), text.filter_bad_sentences("ea_text").alias("kept")
    )
    docs = documents(spark, folder).select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), text.filter_bad_sentences("text").alias("kept")
    )
    return rows.unionByName(docs)


@query(
    "filter_ratio",
    with_tables(
        """SELECT source, count(*) AS documents, round(avg(share), 6) AS mean_removed,
        count(*) FILTER (share > 50) AS heavily_filtered FROM shares GROUP BY source""",
        f"s AS (SELECT source, {q.sentences('text')} AS sent FROM documents)",
        f"""shares AS (SELECT source, CASE WHEN len(sent) = 0 THEN 0.0
        ELSE len(list_filter(sent, lambda s: NOT {q.GOOD_SENTENCE})) / len(sent) * 100 END AS share FROM s)""",
    ),
)
def filter_ratio(spark, folder):
    shares = documents(spark, folder).select("source", text.removed_share("text").alias("share"))
    return shares.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.round(F.avg("share"), 6).alias("mean_removed"),
        F.count_if(F.col("share") > 50).alias("heavily_filtered"),
    )


@query(
    "sentence_split",
    with_tables(
        "SELECT doc_id, generate_subscripts(sent, 1) - 1 AS position, unnest(sent) AS sentence FROM s",
        f"s AS (SELECT doc_id, {q.sentences('text')} AS sent FROM documents)",
    ),
)
def sentence_split(spark, folder):
    docs = documents(spark, folder).select("doc_id", text.split_sentences("text").alias("s"))
    listed = docs.select("doc_id", F.posexplode("s").alias("position", "sentence"))
    return listed.select("doc_id", F.col("position").cast("long").alias("position"), "sentence")


@query(
    "tokenize_stopwords",
    f"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(text, '[^{q.SPACE}]+'),
    lambda t: t NOT IN ({q.quoted(STOP_WORDS)})), ' ') AS tokens FROM documents""",
)
def tokenize_stopwords(spark, folder):
    return documents(spark, folder).select(
        "doc_id", F.array_join(text.tokenize_text("text"), " ").alias("tokens")
    )


@query(
    "process_text",
    with_reports(
        f"""SELECT report_id, t AS processed, array_to_string(list_filter(regexp_extract_all(t, '[^{q.SPACE}]+'),
        lambda t: t NOT IN ({q.quoted(STOP_WORDS)})), '|') AS tokens FROM steps""",
        f"numbers AS (SELECT report_id, {q.replaced_numbers('ea_text')} AS t FROM reports)",
        f"kept AS (SELECT report_id, {q.filtered('t')} AS t FROM numbers)",
        f"steps AS (SELECT report_id, {q.cleaned('t')} AS t FROM kept)",
    ),
)
def process_text(spark, folder):
    texts = reports(spark, folder).select("report_id", text.process_text("ea_text").alias("processed"))
    return texts.select(
        "report_id", "processed", F.array_join(text.tokenize_text("processed"), "|").alias("tokens")
    )


@query(
    "word_tokens_per_language",
    f"""SELECT lang, CAST(sum(len({q.words('text')})) AS BIGINT) AS word_runs,
    CAST(sum(len(list_filter({q.words('text')}, lambda w: regexp_full_match(w, '[a-z_]{{3,}}')))) AS BIGINT) AS ascii_words,
    CAST(sum({q.word_count('text')}) AS BIGINT) AS words FROM documents GROUP BY lang""",
)
def word_tokens_per_language(spark, folder):
    docs = documents(spark, folder).select(
        "lang",
        F.size(text.word_tokens("text")).alias("a"),
        F.size(text.vocabulary_tokens("text", [])).alias("b"),
        text.word_count("text").alias("c"),
    )
    return docs.groupBy("lang").agg(
        F.sum("a").alias("word_runs"), F.sum("b").alias("ascii_words"), F.sum("c").alias("words")
    )


@query(
    "stopword_union",
    with_tables(
        """SELECT word, finance, count(t.word_found) AS uses FROM stop
        LEFT JOIN (SELECT unnest(w) AS word_found FROM tokens) t ON t.word_found = stop.word GROUP BY word, finance""",
        f"tokens AS (SELECT regexp_extract_all(text, '[^{q.SPACE}]+') AS w FROM documents)",
        f"""stop AS (SELECT DISTINCT unnest([{q.quoted(STOP_WORDS)}]) AS word,
        word IN ({q.quoted(FINANCE_STOP_WORDS)}) AS finance)""",
    ),
)
def stopword_union(spark, folder):
    """How often each word of the united stop-word list occurs in the documents."""
    english = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    finance = spark.createDataFrame([(w,) for w in FINANCE_STOP_WORDS], "word string")
    united = english.union(finance).distinct().withColumn("finance", F.col("word").isin(FINANCE_STOP_WORDS))
    found = F.filter(text.tokenize_text("text", remove_stopwords=False), lambda t: t.isin(STOP_WORDS))
    used = documents(spark, folder).select(F.explode(found).alias("word"))
    counts = used.groupBy("word").agg(F.count(F.lit(1)).alias("uses"))
    return united.join(counts, "word", "left").select("word", "finance", F.coalesce("uses", F.lit(0)).alias("uses"))


@query(
    "lexicon_overlap",
    with_reports(
        f"""SELECT term, segment, count(*) AS uses FROM found
        WHERE term IN ({q.quoted(LEXICON["negative"])}) AND term IN ({q.quoted(LEXICON["uncertainty"])})
        GROUP BY term, segment""",
        f"found AS (SELECT segment, unnest({q.words('ea_text')}) AS term FROM reports)",
    ),
)
def lexicon_overlap(spark, folder):
    """Use of the terms that are in two lexicon categories."""
    terms = lexicon.lexicon_table(spark)
    both = terms.where("category = 'negative'").select("term").intersect(
        terms.where("category = 'uncertainty'").select("term")
    )
    found = reports(spark, folder).select("segment", F.explode(text.word_tokens("ea_text")).alias("term"))
    counts = found.join(F.broadcast(both), "term", "left_semi")
    return counts.groupBy("term", "segment").agg(F.count(F.lit(1)).alias("uses"))


CHUNK_SQL = """
pieces AS (
  SELECT doc_id, unnest(list_transform(range(0, greatest(length(text), 1), 512),
    lambda i: substring(text, i + 1, 512))) AS c FROM documents
),
chunk_means AS (
  SELECT doc_id, count(*) AS chunks,
    avg((length(c) - length(replace(c, 'e', ''))) / (length(c) + 1)) AS positive,
    avg((length(c) - length(replace(c, 'o', ''))) / (length(c) + 1)) AS negative
  FROM pieces GROUP BY doc_id
)"""


def letter_share(letter):
    def share(chunk):
        length = F.length(chunk)
        return (length - F.length(F.replace(chunk, F.lit(letter), F.lit("")))) / (length + 1)

    return share


@query(
    "chunk_mean",
    with_tables(
        """SELECT doc_id, chunks, round(positive, 9) AS positive, round(negative, 9) AS negative,
        round(positive - negative, 9) AS net_sentiment, round(positive / (negative + 0.001), 9) AS sentiment_ratio
        FROM chunk_means""",
        CHUNK_SQL,
    ),
)
def chunk_mean(spark, folder):
    """Mean over 512-character chunks of a stand-in score, as a column expression."""
    scored = lexicon.chunk_scores(
        documents(spark, folder), "doc_id", "text", letter_share("e"), letter_share("o")
    )
    columns = ["positive", "negative", "net_sentiment", "sentiment_ratio"]
    return rounded(scored, ["doc_id", F.col("chunks").cast("long").alias("chunks")], columns, 9)


@query(
    "custom_analyzer",
    """SELECT doc_id, len(regexp_extract_all(text, '[A-Z]'))::DOUBLE AS capitals,
    (length(text) - length(replace(text, '!', '')))::DOUBLE AS shouts FROM documents""",
)
def custom_analyzer(spark, folder):
    """A user analyser ``text -> dict`` that is registered by name and called from SQL."""

    def analyse(value):
        return {"capitals": float(sum("A" <= c <= "Z" for c in value)), "shouts": float(value.count("!"))}

    lexicon.custom_analyzer("capital_letters", analyse, ["capitals", "shouts"], spark)
    scored = documents(spark, folder).select("doc_id", F.call_function("capital_letters", F.col("text")).alias("s"))
    return scored.select("doc_id", "s.*")


@query(
    "plugin_sentiment",
    with_tables(
        """SELECT doc_id, round(positive, 9) AS positive, round(negative, 9) AS negative,
        round(positive - negative, 9) AS net_sentiment, round(positive / (negative + 0.001), 9) AS sentiment_ratio
        FROM chunk_means""",
        CHUNK_SQL,
    ),
)
def plugin_sentiment(spark, folder):
    """The same stand-in score from a plug-in model that runs in the tasks."""

    def letter_scorer():
        def score(chunks):
            return [
                {"positive": c.count("e") / (len(c) + 1), "negative": c.count("o") / (len(c) + 1)} for c in chunks
            ]

        return score

    scored = lexicon.plugin_scores(documents(spark, folder), "doc_id", "text", letter_scorer)
    return rounded(scored, ["doc_id"], ["positive", "negative", "net_sentiment", "sentiment_ratio"], 9)
