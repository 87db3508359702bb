"""Topic models and everything read off them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expr import as_column
from ledgerlens.operators.lda import LdaTopics, fit_many
from ledgerlens.operators.sparse import cells, sum_rows, summed_parts, task_helpers
from ledgerlens.session import small

# Parameters of the LDA model.
LDA_MAX_ITER = 15
LDA_FEATURE_ITER = 20
TOPIC_WORD_PRIOR = 0.01
DOC_TOPIC_PRIOR_FACTOR = 50.0
SEED = 42
# A fit ends when the evidence bound rises by less than this share of its size.
LDA_TOLERANCE = 1e-5

# Which topics of a document are reported, and the smoothing term of the coherence.
MIN_TOPIC_SCORE = 0.01
MAX_DOC_TOPICS = 5
COHERENCE_EPSILON = 1e-12
# Cells of documents handled at once by NMF: cells x topics numbers, few enough for the caches.
NMF_CELLS = 20_000


def doc_topic_prior(topics: int) -> float:
    return min(1.0, DOC_TOPIC_PRIOR_FACTOR / topics)


def fit_lda(
    vectors: DataFrame, vector: str, topics: int, max_iter: int = LDA_MAX_ITER, seed: int = SEED, begun: LdaTopics | None = None
) -> LdaTopics:
    """Variational LDA on all documents in every pass (I10, I11); the state is topics x vocabulary.

    ``begun`` is a model of the same rows, topics and seed after fewer passes, from which the fit goes on.
    """
    return fit_lda_grid(vectors, vector, [topics], max_iter, seed, begun and [begun])[0]


def fit_lda_grid(
    vectors: DataFrame, vector: str, counts: list[int], max_iter: int = LDA_MAX_ITER, seed: int = SEED, begun: list[LdaTopics] | None = None
) -> list[LdaTopics]:
    """One model for each topic count, all fitted in the same passes over the documents."""
    priors = [doc_topic_prior(k) for k in counts]
    return fit_many(vectors, vector, counts, priors, TOPIC_WORD_PRIOR, max_iter, LDA_TOLERANCE, seed, begun)


def topic_word_weights(spark: SparkSession, matrix, vocabulary: list[str]) -> DataFrame:
    """Topic-word weights as rows ``(topic, term, weight)``; topics x vocabulary is bounded by the model."""
    rows = [
        (topic, term, float(matrix[position, topic]))
        for position, term in enumerate(vocabulary)
        for topic in range(matrix.shape[1])
    ]
    return spark.createDataFrame(rows, "topic int, term string, weight double")


def top_words(weights: DataFrame, n: int = 10, group: str = "topic", weight: str = "weight") -> DataFrame:
    """The ``n`` heaviest words of every topic (E1): ``(topic, rank, term, weight)``.

    Spark keeps only the best ``n`` of each topic per task before the shuffle, so a topic may hold most of the rows.
    """
    order = Window.partitionBy(group).orderBy(F.desc(weight), "term")
    ranked = weights.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.select(group, "rank", "term", weight)


def word_lists(top: DataFrame, group: str = "topic") -> DataFrame:
    """Ranked words as one array per topic; the arrays are bounded by the ``n`` of ``top_words``."""
    pairs = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return top.groupBy(group).agg(F.transform(pairs, lambda p: p["term"]).alias("words"))


def topic_words(top: DataFrame, topic: int | str, n: int = 10) -> DataFrame:
    """Ranked words of one topic (E2); none for an unknown topic."""
    return top.where((F.col("topic") == topic) & (F.col("rank") <= n)).orderBy("rank")


def format_topics(lists: DataFrame, n: int = 5, group: str = "topic") -> DataFrame:
    """Topics as text, in order of their id."""
    words = F.concat_ws(", ", F.slice("words", 1, n))
    label = F.concat(F.lit("Topic "), F.col(group).cast("string"))
    return lists.select(group, label.alias("topic_label"), words.alias("top_words")).orderBy(group)


def rank_decay(top: DataFrame, group: str = "topic") -> DataFrame:
    """Weights ``(n - i) / n`` that fall with the rank (E9); groups hold at most the ``n`` of ``top_words``."""
    size = F.count(F.lit(1)).over(Window.partitionBy(group))
    return top.select(group, "rank", "term", ((size + 1 - F.col("rank")) / size).alias("decay"))


def best_topics(scores: Column, limit: int = MAX_DOC_TOPICS, threshold: float = MIN_TOPIC_SCORE) -> Column:
    """Topics of one document above the threshold, best first, at equal score the lower id first.

    Works on the score array in its row; no shuffle.
    """
    pairs = F.transform(scores, lambda s, i: F.struct((-s).alias("order"), i.alias("topic"), s.alias("score")))
    good = F.filter(pairs, lambda p: p["score"] > threshold)
    return F.slice(F.sort_array(good), 1, limit)


def document_topics(df: DataFrame, key: str, scores: Column) -> DataFrame:
    """Best topics as rows ``(key, rank, topic, score)``."""
    listed = df.select(key, F.posexplode(best_topics(scores)).alias("p", "t"))
    return listed.select(key, (F.col("p") + 1).alias("rank"), F.col("t.topic").alias("topic"), F.col("t.score"))


def score_documents(model, vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Best topics of documents by a fitted LDA model (I13); a document without known terms gets topic 0."""
    scored = model.transform(vectors)
    empty = F.size(F.unwrap_udt(vector)["indices"]) == 0
    default = F.array(F.lit(1.0))
    scores = F.when(empty, default).otherwise(vector_to_array("topic_vector"))
    return document_topics(scored, key, scores)


def label_topics(doc_topics: DataFrame, lists: DataFrame, n: int = 10) -> DataFrame:
    """Attach the first words of each topic (C5). There is one row per topic of the model."""
    words = lists.select("topic", F.concat_ws(", ", F.slice("words", 1, n)).alias("topic_words"))
    return doc_topics.join(small(words), "topic", "left")


def umass_coherence(
    documents: DataFrame, tokens: Column | str, top: DataFrame, group: str = "topic", topics_per_pass: int = 2000
) -> DataFrame:
    """UMass coherence of every topic (D20): ``(topic, umass)``.

    ``top`` holds topics x n ranked words, a table of the size of the model. For a pair (word, earlier word) the value
    is ``ln((both / N + epsilon) / (earlier / N))``. ``topics_per_pass`` bounds the counts that a task holds.
    """
    ranked: dict = {}
    for row in top.orderBy(group, "rank").collect():
        ranked.setdefault(row[group], []).append(row["term"])
    names, values = list(ranked), []
    for start in range(0, len(names), topics_per_pass):
        values += coherences(documents, tokens, [ranked[n] for n in names[start : start + topics_per_pass]])
    group_type = top.schema[group].dataType.simpleString()
    rows = [(name, value) for name, value in zip(names, values) if value is not None]
    return documents.sparkSession.createDataFrame(rows, f"{group} {group_type}, umass double")


def coherences(documents: DataFrame, tokens: Column | str, lists: list[list[str]]) -> list[float | None]:
    """UMass coherence of each ranked word list, None for fewer than two words; one pass over the documents for all lists."""
    import numpy as np

    counts, total = pair_counts(documents, tokens, lists)
    found = []
    for both, words in zip(counts, lists):
        later, before = np.tril_indices(len(words), -1)
        alone = both[before, before]
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.log((both[later, before] / total + COHERENCE_EPSILON) / (alone / total))
        found.append(float(np.where(alone == 0, 0.0, value).mean()) if len(later) else None)
    return found


def pair_counts(documents: DataFrame, tokens: Column | str, lists: list[list[str]], block: int = 256):
    """(lists x words x words, documents): in how many documents two words of a list are together, and the number of all.

    A task marks for a block of documents which words of any list they hold, and multiplies the marks of each list with
    themselves; its sums have the size of the lists.
    """
    import numpy as np

    words = sorted({w for terms in lists for w in terms})
    number = {w: i for i, w in enumerate(words)}
    longest = max((len(terms) for terms in lists), default=0)
    # Unused places point behind the last word, where no document has a mark.
    places = np.full((len(lists), longest), len(words))
    for i, terms in enumerate(lists):
        places[i, : len(terms)] = [number[w] for w in terms]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        wanted, rows = pa.array(words, pa.string()), 0
        together = np.zeros((len(places), longest, longest))
        for batch in batches:
            rows += batch.num_rows
            for start in range(0, batch.num_rows, block):
                part = batch.column(0).slice(start, block)
                row = pc.list_parent_indices(part).to_numpy()
                word = pc.index_in(part.flatten(), value_set=wanted).fill_null(-1).to_numpy()
                mark = np.zeros((len(part), len(words) + 1), np.float32)
                mark[row[word >= 0], word[word >= 0]] = 1
                own = mark[:, places].transpose(1, 0, 2)
                together += own.transpose(0, 2, 1) @ own
        yield 0, np.r_[together.ravel(), rows]

    sums = summed_parts(documents.select(as_column(tokens).cast("array<string>").alias("t")), run)
    flat = sums.get(0, np.zeros(len(lists) * longest**2 + 1))
    return flat[:-1].reshape(len(lists), longest, longest), int(flat[-1])


def matrix_terms(vector: str, vocabulary: list[str]) -> Column:
    """The vocabulary terms of a document, read off its row of the matrix; n-grams are found like words."""
    names = F.lit(vocabulary)
    return F.transform(F.unwrap_udt(vector)["indices"], lambda i: F.get(names, i))


def tune_topics(
    vectors: DataFrame,
    vector: str,
    vocabulary: list[str],
    documents: DataFrame,
    tokens: Column | str,
    counts: list[int],
    n_words: int = 20,
    max_iter: int = LDA_MAX_ITER,
) -> DataFrame:
    """Fit one model per topic count and record its mean coherence (I14): ``(topics, mean_umass)``.

    ``documents`` and ``tokens`` give the terms of each document as the vocabulary spells them (``matrix_terms``). All models are
    fitted in the same passes, and one more pass counts the word pairs of all their topics.
    """
    import numpy as np

    models = fit_lda_grid(vectors, vector, counts, max_iter)
    lists, owner = [], []
    for position, model in enumerate(models):
        for weights in model.weights:
            best = np.lexsort((vocabulary, -weights))[:n_words]
            lists.append([vocabulary[i] for i in best])
            owner.append(position)
    values = coherences(documents, tokens, lists)
    means = [float(np.mean([v for v, o in zip(values, owner) if o == p and v is not None] or [np.nan])) for p in range(len(models))]
    return vectors.sparkSession.createDataFrame(list(zip(counts, means)), "topics int, mean_umass double")


def best_topic_count(records: DataFrame) -> DataFrame:
    """Topic count with the highest coherence; ties go to the smaller count."""
    order = F.struct(F.col("mean_umass"), -F.col("topics"))
    return records.agg(F.max_by("topics", order).alias("topics"), F.max("mean_umass").alias("mean_umass"))


class NmfModel:
    """Factors of a non-negative matrix: ``components`` is topics x vocabulary."""

    def __init__(self, components, errors: list[float], inner: int):
        self.components, self.errors, self.inner = components, errors, inner

    def transform(self, vectors: DataFrame, vector: str, output: str = "weights") -> DataFrame:
        """Add the topic weights of documents with the components held fixed."""
        shared = vectors.sparkSession.sparkContext.broadcast(self.components)
        inner = self.inner
        weigh = _weigher()

        @F.pandas_udf("array<double>")
        def solve(i: pd.Series, x: pd.Series) -> pd.Series:
            found = []
            for _, weights, *_ in weigh(pd.DataFrame({"i": i, "x": x}), shared.value, inner):
                found.extend(weights)
            return pd.Series(found)

        sparse = F.unwrap_udt(vector)
        return vectors.withColumn(output, solve(sparse["indices"], sparse["values"]))


def _weigher():
    """Weights of a batch of documents for fixed components, by multiplicative updates (runs inside tasks)."""
    pieces, row_sums, _ = task_helpers(NMF_CELLS)

    def weigh(frame, components, inner):
        import numpy as np

        gram = components @ components.T
        for part, rows, columns, values in pieces(frame):
            target = row_sums(rows, values[:, None] * components.T[columns], len(part))
            weights = np.full((len(part), len(components)), 1.0 / len(components))
            for _ in range(inner):
                weights *= target / (weights @ gram + 1e-12)
            yield part, weights, target, rows, columns, values

    return weigh


def fit_nmf(
    vectors: DataFrame, vector: str, topics: int, iterations: int = 20, inner: int = 30, seed: int = SEED
) -> NmfModel:
    """Non-negative factorisation with squared error.

    The components (topics x vocabulary) are bounded and travel to the tasks. Each round a task solves the weights of
    its own documents and returns sums of the size of the components, so no weights are kept between rounds, nothing is
    joined, and a lost task is simply run again.
    """
    import numpy as np

    spark = vectors.sparkSession
    found = cells(vectors.select(vector), vector)
    opened = F.unwrap_udt(vector)
    total = F.aggregate(opened["values"], F.lit(0.0), lambda acc, x: acc + x)
    size, mean = vectors.select(opened["size"].alias("size"), total.alias("s")).agg(F.max("size"), F.avg("s")).first()
    random = np.random.default_rng(seed)
    scale = np.sqrt(max(mean or 0.0, 1e-9) / size / topics)
    components = random.random((topics, size)) * scale + 1e-9
    weigh = _weigher()
    _, _, column_sums = task_helpers()
    errors = []
    for _ in range(iterations):
        shared = spark.sparkContext.broadcast(components)

        def run(frames: Iterator, shared=shared) -> Iterator:
            import numpy as np
            import pandas as pd

            factors = shared.value
            own_gram = factors @ factors.T
            cross, gram, error = np.zeros((factors.shape[1], len(factors))), np.zeros_like(own_gram), 0.0
            for frame in frames:
                for _, weights, target, rows, columns, values in weigh(frame, factors, inner):
                    cross += column_sums(columns, values[:, None] * weights[rows], len(cross))
                    part = weights.T @ weights
                    gram += part
                    error += float((values**2).sum() - 2 * (weights * target).sum() + (part * own_gram).sum())
            used = np.flatnonzero(cross.any(axis=1))
            yield pd.DataFrame(
                {
                    "kind": ["cross"] * len(used) + ["gram"] * len(gram) + ["error"],
                    "i": np.concatenate([used, np.arange(len(gram)), [0]]),
                    "sums": [*cross[used], *gram, np.array([error] + [0.0] * (len(gram) - 1))],
                }
            )

        sums = found.mapInPandas(run, "kind string, i long, sums array<double>")
        cross, gram, error = np.zeros((size, topics)), np.zeros((topics, topics)), 0.0
        for row in sum_rows(sums, topics):
            numbers = row[2:]
            if row["kind"] == "cross":
                cross[row["i"]] = numbers
            elif row["kind"] == "gram":
                gram[row["i"]] = numbers
            else:
                error = numbers[0]
        errors.append(float(error))
        components = components * (cross.T / (gram @ components + 1e-12))
        shared.unpersist()
    return NmfModel(components, errors, inner)
