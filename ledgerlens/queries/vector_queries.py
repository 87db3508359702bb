"""Queries on vocabularies, matrices and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.text import vocabulary_tokens, word_tokens
from ledgerlens.operators import evaluate, features, topics, vectorize, word_vectors
from ledgerlens.queries import sql_text as q
from ledgerlens.queries.registry import documents, query, scratch, table, with_tables
from ledgerlens.session import stage
from ledgerlens.sources import models as saved

VOCABULARY_SIZE = vectorize.MAX_FEATURES
# Topics of a model, and the grid that the search for their number tries.
TOPICS, TOPIC_COUNTS = 40, list(range(10, 101, 5))

TERMS_SQL = f"""
tokens AS (SELECT doc_id, lang, source, {q.vocabulary('text')} AS t FROM documents),
grams AS (
  SELECT doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM tokens
),
cells AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM cells GROUP BY term),
size AS (SELECT count(*) AS docs FROM documents),
vocabulary AS (
  SELECT term, cf, df FROM stats WHERE df <= 0.95 * (SELECT docs FROM size) ORDER BY cf DESC, term LIMIT {VOCABULARY_SIZE}
)"""


def fitted(docs, method="count", size=VOCABULARY_SIZE):
    return vectorize.fit_vectorizer(docs, "text", method, size)


@query(
    "ngrams_top",
    with_tables(
        "SELECT term, cf AS uses FROM stats WHERE term LIKE '% %' ORDER BY cf DESC, term LIMIT 100", TERMS_SQL
    ),
)
def ngrams_top(spark, folder):
    """The 100 most frequent pairs of words."""
    terms = documents(spark, folder).select(F.explode(vectorize.terms_of("text")).alias("term"))
    counts = terms.where(F.col("term").contains(" ")).groupBy("term").agg(F.count(F.lit(1)).alias("uses"))
    return counts.orderBy(F.desc("uses"), "term").limit(100)


@query("vocab_topk", with_tables("SELECT term, cf, df FROM vocabulary", TERMS_SQL))
def vocab_topk(spark, folder):
    docs = documents(spark, folder)
    terms = docs.select(vectorize.terms_of("text").alias("terms"))
    return vectorize.frequent_terms(terms, docs.count(), VOCABULARY_SIZE, vectorize.MAX_DOC_FREQ)


@query(
    "document_frequency",
    with_tables(
        "SELECT df, count(*) AS terms, count(*) FILTER (df <= 0.95 * (SELECT docs FROM size)) AS kept "
        "FROM stats GROUP BY df",
        TERMS_SQL,
    ),
)
def document_frequency(spark, folder):
    """How many terms are in how many documents, and how many of them the upper limit keeps."""
    docs = documents(spark, folder)
    stats = vectorize.term_statistics(docs.select(vectorize.terms_of("text").alias("terms")))
    total = docs.count()
    return stats.groupBy("df").agg(
        F.count(F.lit(1)).alias("terms"), F.count_if(F.col("df") <= 0.95 * total).alias("kept")
    )


@query(
    "dtm_long",
    with_tables("SELECT doc_id, term, tf::DOUBLE AS tf FROM cells JOIN vocabulary USING (term)", TERMS_SQL),
)
def dtm_long(spark, folder):
    docs = documents(spark, folder)
    return fitted(docs).long(docs, "doc_id", "tf")


@query(
    "tfidf_long",
    with_tables(
        """SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM weighted""",
        TERMS_SQL,
        """weighted AS (SELECT doc_id, term, tf * (ln((1 + docs) / (1 + df)::DOUBLE) + 1) AS w
        FROM cells JOIN vocabulary USING (term), size)""",
    ),
)
def tfidf_long(spark, folder):
    docs = documents(spark, folder)
    cells = fitted(docs, "tfidf").long(docs, "doc_id", "tfidf")
    return cells.select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@query(
    "matrix_density",
    with_tables(
        """SELECT docs AS total_documents, (SELECT count(*) FROM vocabulary) AS vocabulary_size,
        round((SELECT count(*) FROM cells JOIN vocabulary USING (term))
          / (docs * (SELECT count(*) FROM vocabulary)), 9) AS density, round(mean, 6) AS mean_length,
        med AS median_length, lo AS min_length, hi AS max_length FROM size, lengths""",
        TERMS_SQL,
        f"""lengths AS (SELECT avg(n) AS mean, median(n)::DOUBLE AS med, min(n) AS lo, max(n) AS hi
        FROM (SELECT {q.word_count('text')} AS n FROM documents))""",
    ),
)
def matrix_density(spark, folder):
    docs = documents(spark, folder)
    stats = vectorize.matrix_statistics(docs, fitted(docs))
    return stats.select(
        "total_documents",
        F.col("vocabulary_size").cast("long").alias("vocabulary_size"),
        F.round("density", 9).alias("density"),
        F.round("mean_length", 6).alias("mean_length"),
        "median_length",
        F.col("min_length").cast("long").alias("min_length"),
        F.col("max_length").cast("long").alias("max_length"),
    )


# Words of one source stand in for the words of one topic: every source is a topic, its word counts are the weights.
SOURCE_WORDS_SQL = f"""
source_tokens AS (SELECT doc_id, source, {q.vocabulary('text')} AS t FROM documents),
source_words AS (
  SELECT source, term, count(*) AS weight FROM (SELECT source, unnest(t) AS term FROM source_tokens) GROUP BY ALL
),
ranked AS (
  SELECT source, term, weight, row_number() OVER (PARTITION BY source ORDER BY weight DESC, term) AS rank
  FROM source_words
),
top AS (SELECT source, CAST(rank AS INTEGER) AS rank, term, weight FROM ranked WHERE rank <= 10)"""


def source_weights(docs):
    words = docs.select("source", F.explode(vocabulary_tokens("text")).alias("term"))
    return words.groupBy("source", "term").agg(F.count(F.lit(1)).alias("weight"))


def source_top(docs, n=10):
    return topics.top_words(source_weights(docs), n, "source")


@query("topic_top_words", with_tables("SELECT source, rank, term, weight FROM top", SOURCE_WORDS_SQL))
def topic_top_words(spark, folder):
    return source_top(documents(spark, folder))


@query(
    "topic_word_lists",
    with_tables(
        """SELECT source, 'Topic ' || source AS topic_label,
        string_agg(term, ', ' ORDER BY rank) FILTER (rank <= 5) AS top_words FROM top GROUP BY source""",
        SOURCE_WORDS_SQL,
    ),
)
def topic_word_lists(spark, folder):
    lists = topics.word_lists(source_top(documents(spark, folder)), "source")
    return topics.format_topics(lists, 5, "source")


@query(
    "rank_decay",
    with_tables(
        "SELECT source, rank, term, round((count(*) OVER (PARTITION BY source) + 1 - rank) "
        "/ count(*) OVER (PARTITION BY source), 6) AS decay FROM top",
        SOURCE_WORDS_SQL,
    ),
)
def rank_decay(spark, folder):
    decay = topics.rank_decay(source_top(documents(spark, folder)), "source")
    return decay.select("source", "rank", "term", F.round("decay", 6).alias("decay"))


UMASS_SQL = """
presence AS (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest(t) AS term FROM source_tokens)
  WHERE term IN (SELECT term FROM top)),
single AS (SELECT term, count(*) AS n FROM presence GROUP BY term),
both_words AS (
  SELECT a.term AS w, b.term AS v, count(*) AS n FROM presence a JOIN presence b ON a.doc_id = b.doc_id
  WHERE a.term <> b.term GROUP BY ALL
),
pairs AS (
  SELECT a.source, a.rank, ln((coalesce(c.n, 0) / d.docs + 1e-12) / (s.n / d.docs)) AS value
  FROM top a JOIN top b ON a.source = b.source AND b.rank < a.rank
  JOIN single s ON s.term = b.term LEFT JOIN both_words c ON c.w = a.term AND c.v = b.term,
  (SELECT count(*)::DOUBLE AS docs FROM documents) d
),
coherence AS (SELECT source, avg(value) AS umass FROM pairs GROUP BY source)"""


@query(
    "umass_coherence",
    with_tables("SELECT source, round(umass, 6) AS umass FROM coherence", SOURCE_WORDS_SQL, UMASS_SQL),
)
def umass_coherence(spark, folder):
    docs = documents(spark, folder)
    result = topics.umass_coherence(docs, vocabulary_tokens("text"), source_top(docs), "source")
    return result.select("source", F.round("umass", 6).alias("umass"))


BEST_K_PARTS = "\n".join(
    f"""k{n}_pairs AS (
  SELECT a.source, ln((coalesce(c.n, 0) / d.docs + 1e-12) / (s.n / d.docs)) AS value
  FROM top a JOIN top b ON a.source = b.source AND b.rank < a.rank AND a.rank <= {n}
  JOIN single s ON s.term = b.term LEFT JOIN both_words c ON c.w = a.term AND c.v = b.term,
  (SELECT count(*)::DOUBLE AS docs FROM documents) d),
k{n} AS (SELECT {n} AS topics, avg(m) AS mean_umass FROM (SELECT avg(value) AS m FROM k{n}_pairs GROUP BY source)),"""
    for n in (3, 5, 10)
).rstrip(",")


@query(
    "best_k",
    with_tables(
        """SELECT topics, round(mean_umass, 6) AS mean_umass FROM
        (SELECT * FROM k3 UNION ALL SELECT * FROM k5 UNION ALL SELECT * FROM k10)
        ORDER BY mean_umass DESC, topics LIMIT 1""",
        SOURCE_WORDS_SQL,
        UMASS_SQL,
        BEST_K_PARTS,
    ),
)
def best_k(spark, folder):
    """Setting with the highest mean coherence; here the number of words per topic is the setting."""
    docs = documents(spark, folder)
    weights = stage(source_weights(docs), "source-words")
    rows = []
    for n in (3, 5, 10):
        top = topics.top_words(weights, n, "source")
        mean = topics.umass_coherence(docs, vocabulary_tokens("text"), top, "source").agg(F.avg("umass"))
        rows.append((n, mean.first()[0]))
    best = topics.best_topic_count(spark.createDataFrame(rows, "topics int, mean_umass double"))
    return best.select("topics", F.round("mean_umass", 6).alias("mean_umass"))


DOC_TOPICS_SQL = """
scores AS (SELECT vec_id, unnest(embedding)::DOUBLE AS score, generate_subscripts(embedding, 1) - 1 AS topic
  FROM embeddings),
good AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, topic) AS rank FROM scores
  WHERE score > 0.01),
best AS (SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(topic AS INTEGER) AS topic, score FROM good
  WHERE rank <= 5)"""


@query("doc_top_topics", with_tables("SELECT vec_id, rank, topic, round(score, 6) AS score FROM best", DOC_TOPICS_SQL))
def doc_top_topics(spark, folder):
    vectors = table(spark, folder, "embeddings")
    best = topics.document_topics(vectors, "vec_id", F.col("embedding").cast("array<double>"))
    return best.select("vec_id", "rank", "topic", F.round("score", 6).alias("score"))


@query(
    "topic_words_join",
    with_tables(
        """SELECT b.vec_id, b.rank, b.topic, w.topic_words FROM best b LEFT JOIN words w ON w.topic = b.topic""",
        DOC_TOPICS_SQL,
        SOURCE_WORDS_SQL,
        """ids AS (SELECT source, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS topic
        FROM (SELECT DISTINCT source FROM documents))""",
        """words AS (SELECT topic, string_agg(term, ', ' ORDER BY rank) AS topic_words
        FROM top JOIN ids USING (source) GROUP BY topic)""",
    ),
)
def topic_words_join(spark, folder):
    """Best topics of each vector with the words of the topic; topic numbers are those of the sources in order."""
    docs = documents(spark, folder)
    lists = topics.word_lists(source_top(docs), "source")
    # One row per source: the sources are the topics of this model.
    names = [r[0] for r in docs.select("source").distinct().orderBy("source").collect()]
    ids = spark.createDataFrame(list(enumerate(names)), "topic int, source string")
    numbered = lists.join(F.broadcast(ids), "source").select("topic", "words")
    best = topics.document_topics(
        table(spark, folder, "embeddings"), "vec_id", F.col("embedding").cast("array<double>")
    )
    return topics.label_topics(best, numbered).select("vec_id", "rank", "topic", "topic_words")


@query(
    "class_word_freq",
    with_tables(
        "SELECT word, count(*) AS uses FROM found GROUP BY word ORDER BY uses DESC, word LIMIT 100",
        f"found AS (SELECT unnest({q.words('text')}) AS word FROM documents JOIN labels USING (doc_id) WHERE quality = 1)",
    ),
)
def class_word_freq(spark, folder):
    """The 100 most frequent words in the texts of one class."""
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    words = documents(spark, folder).join(good, "doc_id").select(F.explode(word_tokens("text")).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("uses"))
    return counts.orderBy(F.desc("uses"), "word").limit(100)


def matrix(spark, folder, size=vectorize.MAX_FEATURES, method="count"):
    docs = documents(spark, folder).select("doc_id", "text")
    model = vectorize.fit_vectorizer(docs, "text", method, size)
    return stage(model.transform(docs).select("doc_id", "vector"), "matrix"), model


@query("lda_topics")
def lda_topics(spark, folder):
    """Topics of documents by a fitted LDA model."""
    vectors, _ = matrix(spark, folder)
    model = topics.fit_lda(vectors, "vector", TOPICS)
    return topics.score_documents(model, vectors, "doc_id", "vector")


@query("lda_topic_words")
def lda_topic_words(spark, folder):
    vectors, vectorizer = matrix(spark, folder)
    model = topics.fit_lda(vectors, "vector", TOPICS)
    weights = topics.topic_word_weights(spark, model.topics_matrix(), vectorizer.vocabulary)
    return topics.top_words(weights)


@query("nmf_topics")
def nmf_topics(spark, folder):
    vectors, _ = matrix(spark, folder, method="tfidf")
    model = topics.fit_nmf(vectors, "vector", TOPICS)
    return model.transform(vectors, "vector").select("doc_id", "weights")


@query("svd_features")
def svd_features(spark, folder):
    vectors, _ = matrix(spark, folder, method="tfidf")
    scored = features.fit_lsa(vectors, "vector").transform(vectors, "vector")
    return scored.select("doc_id", "semantic")


@query("svd_explained_variance")
def svd_explained_variance(spark, folder):
    vectors, vectorizer = matrix(spark, folder, method="tfidf")
    scores = stage(features.fit_lsa(vectors, "vector").transform(vectors, "vector").select("semantic"), "lsa")
    return features.explained_variance(scores, "semantic", vectors, "vector", len(vectorizer.vocabulary))


@query("tune_topics")
def tune_topics(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    model = vectorize.fit_vectorizer(docs, "text", "count")
    vectors = stage(
        model.transform(docs).select("doc_id", "vector", vectorize.terms_of("text").alias("terms")), "tuning"
    )
    return topics.tune_topics(vectors, "vector", model.vocabulary, vectors, "terms", TOPIC_COUNTS)


@query("word2vec_docs")
def word2vec_docs(spark, folder):
    """Averaged word vectors of documents."""
    from pyspark.ml.functions import vector_to_array

    docs = stage(documents(spark, folder).select("doc_id", "text"), "texts")
    embedder = features.Embedder("word2vec").fit(docs, "text")
    return embedder.transform(docs).select("doc_id", vector_to_array("embedding").alias("embedding"))


@query(
    "plugin_embeddings",
    """SELECT doc_id, length(text)::DOUBLE AS x0, (length(text) - length(replace(text, ' ', '')))::DOUBLE AS x1,
    (length(text) - length(replace(text, '.', '')))::DOUBLE AS x2 FROM documents""",
)
def plugin_embeddings(spark, folder):
    """Embeddings from a plug-in encoder that runs in the tasks."""

    def shape_encoder():
        def encode(texts):
            return [[len(t), t.count(" "), t.count(".")] for t in texts]

        return encode

    encoded = features.encode_texts(documents(spark, folder), "doc_id", "text", shape_encoder)
    return encoded.select("doc_id", *[F.col("embedding")[i].alias(f"x{i}") for i in range(3)])


@query(
    "embedder_reload",
    with_tables(
        """SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM weighted""",
        TERMS_SQL,
        """weighted AS (SELECT doc_id, term, tf * (ln((1 + docs) / (1 + df)::DOUBLE) + 1) AS w
        FROM cells JOIN vocabulary USING (term), size)""",
    ),
)
def embedder_reload(spark, folder):
    """TF-IDF embeddings from an embedder that was saved and loaded again."""
    docs = documents(spark, folder).select("doc_id", "text")
    path = scratch(spark, "embedder")
    saved.save_embedder(spark, features.Embedder("tfidf", VOCABULARY_SIZE).fit(docs, "text"), path)
    embedder = saved.load_embedder(spark, path)
    cells = vectorize.vector_cells(
        embedder.transform(docs), "doc_id", "embedding", embedder.model.vocabulary, "tfidf"
    )
    return cells.select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@query("topic_model_reload")
def topic_model_reload(spark, folder):
    """Topics of documents from a saved and loaded model, with the words of each topic."""
    vectors, vectorizer = matrix(spark, folder)
    path = scratch(spark, "topic-model")
    saved.save_topic_model(spark, topics.fit_lda(vectors, "vector", TOPICS), vectorizer.vocabulary, path)
    model, vocabulary = saved.load_topic_model(spark, path)
    weights = topics.topic_word_weights(spark, model.topics_matrix(), vocabulary)
    lists = topics.word_lists(topics.top_words(weights))
    return topics.label_topics(topics.score_documents(model, vectors, "doc_id", "vector"), lists)


@query(
    "topic_words_single",
    with_tables("SELECT source, rank, term FROM top WHERE source = (SELECT min(source) FROM top) AND rank <= 8", SOURCE_WORDS_SQL),
)
def topic_words_single(spark, folder):
    """Ranked words of one topic; here the first source."""
    docs = documents(spark, folder)
    first = docs.agg(F.min("source")).first()[0]
    words = topics.topic_words(source_top(docs).withColumnRenamed("source", "topic"), first, 8)
    return words.select(F.col("topic").alias("source"), "rank", "term")


@query(
    "classification_report",
    with_tables(
        """SELECT * FROM (
          SELECT CAST(class AS VARCHAR) AS name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
            support FROM measures
          UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n
            FROM (SELECT sum(hit) / sum(support) AS a, CAST(sum(support) AS BIGINT) AS n FROM measures)
          UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
            CAST(sum(support) AS BIGINT) FROM measures
          UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6),
            round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
            CAST(sum(support) AS BIGINT) FROM measures)""",
        "classes AS (SELECT DISTINCT quality AS class FROM labels UNION SELECT DISTINCT toxic FROM labels)",
        """counts AS (SELECT class,
          (SELECT count(*) FROM labels WHERE quality = class AND toxic = class) AS hit,
          (SELECT count(*) FROM labels WHERE quality = class) AS support,
          (SELECT count(*) FROM labels WHERE toxic = class) AS predicted FROM classes)""",
        """shares AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS p,
          CASE WHEN support = 0 THEN 0 ELSE hit / support END AS r FROM counts)""",
        "measures AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM shares)",
    ),
)
def classification_report(spark, folder):
    """Quality as truth, toxicity as prediction."""
    report = evaluate.classification_report(table(spark, folder, "labels"), "quality", "toxic")
    numbers = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return report.select("name", *numbers, "support")


CONTEXTS_SQL = f"""
texts AS (SELECT doc_id, {q.vocabulary('text')} AS t FROM documents),
words AS (SELECT word, count(*) AS n FROM (SELECT unnest(t) AS word FROM texts) GROUP BY word HAVING count(*) >= 5),
pairs AS (
  SELECT t[i] AS a, t[i + d] AS b
  FROM (SELECT t, d, unnest(range(1, len(t) - d + 1)) AS i FROM texts, (SELECT unnest(range(1, 6)) AS d))
),
cells AS (
  SELECT word, other, count(*) AS n
  FROM (SELECT a AS word, b AS other FROM pairs UNION ALL SELECT b, a FROM pairs)
  WHERE word IN (SELECT word FROM words) AND other IN (SELECT word FROM words) GROUP BY ALL
),
sums AS (SELECT word, sum(n) AS r FROM cells GROUP BY word),
weights AS (
  SELECT c.word, c.n, ln(c.n * (SELECT sum(r) FROM sums)::DOUBLE / (s.r::DOUBLE * o.r)) AS weight
  FROM cells c JOIN sums s ON s.word = c.word JOIN sums o ON o.word = c.other
)"""


@query(
    "word_contexts",
    with_tables(
        """SELECT w.word, w.n AS uses, count(weight) AS partners, coalesce(sum(weights.n), 0)::BIGINT AS pairs,
        round(coalesce(sum(weight), 0), 4) AS weight, round(coalesce(max(weight), 0), 6) AS strongest
        FROM words w LEFT JOIN weights ON weights.word = w.word AND weight > 0 GROUP BY w.word, w.n""",
        CONTEXTS_SQL,
    ),
)
def word_contexts(spark, folder):
    """Positive information of words and their neighbours, the matrix that word vectors decompose, summed for each word."""
    parts = word_vectors.code_words(documents(spark, folder), "text")
    words = stage(word_vectors.word_counts(parts).where("n >= 5"), "words")
    cells = word_vectors.information(word_vectors.count_pairs(parts, words))
    sums = cells.groupBy("word").agg(
        F.count(F.lit(1)).alias("partners"), F.sum("n").alias("pairs"), F.sum("weight").alias("weight"), F.max("weight").alias("strongest")
    )
    none = F.lit(0).cast("long")
    return words.join(sums, "word", "left").select(
        "word", F.col("n").alias("uses"), F.coalesce("partners", none).alias("partners"), F.coalesce("pairs", none).alias("pairs"),
        F.round(F.coalesce("weight", F.lit(0.0)), 4).alias("weight"), F.round(F.coalesce("strongest", F.lit(0.0)), 6).alias("strongest"),
    )


@query(
    "word_vector_documents",
    with_tables(
        """SELECT doc_id, (SELECT count(*) FROM (SELECT unnest(t) AS word) u JOIN words USING (word)) AS known,
        50 AS numbers, true AS within FROM texts""",
        CONTEXTS_SQL,
    ),
)
def word_vector_documents(spark, folder):
    """Mean vectors of documents: the words they rest on, and whether their lengths stay within the longest word vector's."""
    docs = stage(documents(spark, folder).select("doc_id", "text"), "texts")
    vectors = word_vectors.fit_vectors(docs, "text")
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    longest = vectors.agg(F.max(length)).first()[0] or 0.0
    found = word_vectors.document_vectors(docs, "doc_id", "text", vectors)
    return found.select("doc_id", "known", F.size("vector").alias("numbers"), (length <= longest + 1e-9).alias("within"))
