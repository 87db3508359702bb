"""Feature sets and their combination."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import VectorAssembler, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import as_column, let
from ledgerlens.functions.text import SPACE_CHARS
from ledgerlens.operators.lda import LdaTopics
from ledgerlens.operators.sparse import cells, summed_parts, task_helpers
from ledgerlens.operators.topics import LDA_FEATURE_ITER, fit_lda
from ledgerlens.operators.vectorize import FittedVectorizer, Vocabulary, fit_vocabulary, terms_of, vectorizer
from ledgerlens.session import stage

STATISTICS = ["word_count", "char_count", "sentence_count", "avg_word_length", "avg_sentence_length"]
# Components of the semantic features, rounds and spare directions of the solver.
SEMANTIC_COMPONENTS = 50
LSA_ITERATIONS = 5
LSA_OVERSAMPLE = 10
WORD_VECTOR_PARTS = 8


def statistical_features(text: Column | str) -> Column:
    """Five length features as a struct (H13); sentences are the pieces between full stops."""
    col = F.coalesce(as_column(text), F.lit("None"))

    def stats(words: Column) -> Column:
        n = F.size(words).cast("double")
        sentences = F.greatest(F.lit(1), F.length(col) - F.length(F.replace(col, F.lit("."), F.lit(""))) + 1)
        letters = F.aggregate(words, F.lit(0), lambda acc, w: acc + F.length(w)).cast("double")
        values = [n, F.length(col).cast("double"), sentences.cast("double")]
        values += [F.when(n > 0, letters / n).otherwise(0.0), n / sentences]
        return F.struct(*[v.alias(name) for v, name in zip(values, STATISTICS)])

    return let(F.regexp_extract_all(col, F.lit(rf"[^{SPACE_CHARS}]+"), F.lit(0)), stats)


def add_statistical_vector(df: DataFrame, text: str, output: str = "statistical") -> DataFrame:
    with_stats = df.withColumn("_s", statistical_features(text))
    return with_stats.withColumn(output, array_to_vector(F.array(*[F.col("_s")[s] for s in STATISTICS]))).drop("_s")


class LsaModel:
    """Right singular vectors and singular values of a document-term matrix."""

    def __init__(self, components, singular_values):
        self.components, self.singular_values = components, singular_values

    def transform(self, df: DataFrame, vector: str, output: str = "semantic") -> DataFrame:
        """Add the coordinates of the documents, ``U s = X V``, as an array of k numbers."""
        shared = df.sparkSession.sparkContext.broadcast(self.components)
        pieces, row_sums, _ = task_helpers()

        @F.pandas_udf("array<double>")
        def project(i: pd.Series, x: pd.Series) -> pd.Series:
            right, scores = shared.value, []
            for part, rows, columns, values in pieces(pd.DataFrame({"i": i, "x": x})):
                scores.extend(row_sums(rows, values[:, None] * right[columns], len(part)))
            return pd.Series(scores)

        sparse = F.unwrap_udt(vector)
        return df.withColumn(output, project(sparse["indices"], sparse["values"]))


def fit_lsa(
    vectors: DataFrame,
    vector: str,
    components: int = SEMANTIC_COMPONENTS,
    iterations: int = LSA_ITERATIONS,
    oversample: int = LSA_OVERSAMPLE,
    seed: int = 42,
) -> LsaModel:
    """Truncated SVD without centring, by randomised subspace iteration.

    A round multiplies a block of vectors by the Gram matrix of the documents: one pass over the rows, whose sums have
    the size vocabulary x block. So the number of passes is ``iterations`` + 1, whatever the number of components.
    """
    import numpy as np

    spark = vectors.sparkSession
    found = cells(vectors.select(vector), vector)
    size = vectors.select(F.unwrap_udt(vector)["size"].alias("n")).first()["n"]
    width = min(size, components + oversample)
    pieces, row_sums, column_sums = task_helpers()

    def multiply(block):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator) -> Iterator:
            import numpy as np

            basis = shared.value
            total = np.zeros(basis.shape)
            for batch in batches:
                for part, rows, columns, values in pieces(batch.to_pandas()):
                    scores = row_sums(rows, values[:, None] * basis[columns], len(part))
                    total += column_sums(columns, values[:, None] * scores[rows], len(total))
            yield 0, total.ravel()

        sums = summed_parts(found.select("i", "x"), run)
        shared.unpersist()
        return sums.get(0, np.zeros(size * width)).reshape(size, width)

    basis, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))
    for _ in range(iterations):
        basis, _ = np.linalg.qr(multiply(basis))
    values, rotation = np.linalg.eigh(basis.T @ multiply(basis))
    best = np.argsort(values)[::-1][:components]
    return LsaModel(basis @ rotation[:, best], np.sqrt(np.maximum(values[best], 0.0)))


def explained_variance(scores: DataFrame, column: str, vectors: DataFrame, vector: str, size: int) -> DataFrame:
    """Share of the variance of the matrix that each component explains (D21): ``(component, ratio)``."""
    parts = scores.select(F.posexplode(column).alias("component", "x"))
    by_part = parts.groupBy("component").agg(F.var_pop("x").alias("variance"))
    cells = vectors.select(F.unwrap_udt(vector).alias("v"))
    cells = cells.select(F.inline(F.arrays_zip(F.col("v.indices").alias("i"), F.col("v.values").alias("x"))))
    rows = vectors.count()
    moments = cells.groupBy("i").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    total = moments.agg(F.sum(F.col("q") / rows - (F.col("s") / rows) * (F.col("s") / rows))).first()[0]
    return by_part.select("component", F.try_divide("variance", F.lit(total)).alias("ratio"))


def fit_word_vectors(
    df: DataFrame, text: str, size: int = 50, min_count: int = 5, seed: int = 42, parts: int = WORD_VECTOR_PARTS, max_terms: int = 100_000
):
    """Word vectors averaged per document (I6); the model keeps ``size`` numbers for each of at most ``max_terms`` words.

    Words are counted first. Where more than ``max_terms`` reach ``min_count``, the most frequent are kept, equal counts in the
    order of the words, so what the fit gathers is bounded. The training is split into ``parts``, whatever the files; every part returns its own copy of the vectors.
    """
    terms = df.select(terms_of(F.coalesce(F.col(text), F.lit("")), bigrams=False).alias("_terms"))
    counts = terms.select(F.explode("_terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    first = counts.where(F.col("n") >= min_count).orderBy(F.desc("n"), "term").limit(max_terms + 1).collect()
    if len(first) > max_terms:
        terms = only_terms(terms, [r["term"] for r in first[:max_terms]])
    return Word2Vec(
        vectorSize=size,
        minCount=min_count,
        seed=seed,
        inputCol="_terms",
        outputCol="embedding",
        maxIter=1,
        numPartitions=parts,
    ).fit(terms)


def only_terms(terms: DataFrame, words: list[str]) -> DataFrame:
    """Arrays of words, ``_terms``, without the words that are not listed."""

    def work(batches):
        known = pa.array(words, pa.string())
        for batch in batches:
            lists = batch.column(0)
            flat, parent = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
            keep = pc.is_in(flat.cast(pa.string()), value_set=known)
            sizes = np.bincount(parent[keep.to_numpy(zero_copy_only=False)], minlength=len(lists))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, flat.filter(keep))], ["_terms"])

    return terms.mapInArrow(work, "_terms array<string>")


def word_vector_embeddings(model, df: DataFrame, text: str) -> DataFrame:
    terms = df.withColumn("_terms", terms_of(F.coalesce(F.col(text), F.lit("")), bigrams=False))
    return model.transform(terms).drop("_terms")


def encode_texts(
    df: DataFrame, key: str, text: str, make_encoder: Callable[[], Callable[[list[str]], object]], batch: int = 32
) -> DataFrame:
    """Embeddings from a plug-in model, in batches (I7, K3): ``(key, embedding)``.

    ``make_encoder`` runs once per task and returns a function from texts to a matrix with one row per text.
    """
    key_type = df.schema[key].dataType.simpleString()

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        encoder = make_encoder()
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                rows = [list(map(float, row)) for row in encoder(part["t"].tolist())]
                yield pd.DataFrame({"key": part["key"].to_numpy(), "embedding": rows})

    texts = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    encoded = texts.mapInPandas(run, f"key {key_type}, embedding array<double>")
    return encoded.withColumnRenamed("key", key)


class Embedder:
    """Text embeddings by method ``bow`` (or ``count``), ``tfidf`` or ``word2vec``."""

    def __init__(self, method: str = "tfidf", max_features: int = 5000):
        if method not in ("bow", "count", "tfidf", "word2vec"):
            raise ValueError(f"unknown embedding method: {method}")
        self.method, self.max_features = method, max_features
        self.model = None
        self.text: str | None = None

    def fit(self, df: DataFrame, text: str, vocabulary: Vocabulary | None = None) -> Embedder:
        """Fit on a text column; a vocabulary that was fitted before saves the pass over the texts."""
        self.text = text
        if self.method == "word2vec":
            self.model = fit_word_vectors(df, text)
        else:
            method = "tfidf" if self.method == "tfidf" else "count"
            vocabulary = vocabulary or fit_vocabulary(df, text, self.max_features)
            self.model = vectorizer(vocabulary, text, method, output="embedding")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("the embedder is not fitted")
        if self.method == "word2vec":
            return word_vector_embeddings(self.model, df, self.text)
        return self.model.transform(df)

    def fit_transform(self, df: DataFrame, text: str) -> DataFrame:
        return self.fit(df, text).transform(df)


def combine_features(df: DataFrame, sets: list[str], available: list[str], output: str = "features") -> DataFrame:
    """Join vector columns of the same row into one vector (C4)."""
    for name in sets:
        if name not in available:
            raise KeyError(f"feature set {name!r} not found")
    return VectorAssembler(inputCols=sets, outputCol=output, handleInvalid="error").transform(df)


def join_features(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Join feature tables that were stored apart, by key (C4)."""
    joined = None
    for table in tables.values():
        joined = table if joined is None else joined.join(table, key)
    return joined


def feature_names(sizes: dict[str, int]) -> list[str]:
    """``stat_0 ..``, ``sem_0 ..``, ``topic_0 ..`` for the given sizes, in order."""
    return [f"{prefix}_{i}" for prefix, size in sizes.items() for i in range(size)]


class FeatureBundle:
    """Statistical, semantic and topic features of a text column."""

    def __init__(
        self,
        text: str,
        max_features: int = 5000,
        semantic_components: int = SEMANTIC_COMPONENTS,
        topics: int = 40,
        statistical: bool = True,
        semantic: bool = True,
        topic: bool = True,
        topic_iterations: int = LDA_FEATURE_ITER,
    ):
        self.text, self.max_features = text, max_features
        self.semantic_components, self.topics, self.topic_iterations = semantic_components, topics, topic_iterations
        self.use = {"statistical": statistical, "semantic": semantic, "topics": topic}
        self.vectorizer: FittedVectorizer | None = None
        self.lsa: LsaModel | None = None
        self.lda = None

    def fit(
        self, df: DataFrame, vocabulary: Vocabulary | None = None, vectors: DataFrame | None = None, begun: LdaTopics | None = None
    ) -> FeatureBundle:
        """Fit on a text column. A vocabulary and a stored matrix ``dtm`` that exist already are used as they are.

        ``begun`` is a topic model of that matrix with as many topics, after fewer passes; the topics are fitted on from it.
        """
        vocabulary = vocabulary or fit_vocabulary(df, self.text, self.max_features)
        self.vectorizer = vectorizer(vocabulary, self.text, "count", output="dtm")
        if vectors is None:
            # The solvers read the matrix many times.
            vectors = stage(self.vectorizer.transform(df.select(self.text)).select("dtm"), "dtm")
        if self.use["semantic"]:
            self.lsa = fit_lsa(vectors, "dtm", self.semantic_components)
        if self.use["topics"]:
            self.lda = fit_lda(vectors, "dtm", self.topics, self.topic_iterations, begun=begun)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the feature vectors that are switched on, the matrix row ``dtm``, and all of them as ``features``.

        Everything is computed in the row of its document, so no table is joined.
        """
        if self.vectorizer is None:
            raise ValueError("the feature bundle is not fitted")
        result = self.vectorizer.transform(df)
        if self.use["statistical"]:
            result = add_statistical_vector(result, self.text)
        return self.from_matrix(result)

    def from_matrix(self, result: DataFrame) -> DataFrame:
        """The same from a table that holds ``dtm`` and, where it is used, ``statistical`` already: no text is read."""
        if self.lda is not None:
            result = self.lda.set_output("topics").transform(result)
        if self.lsa is not None:
            result = self.lsa.transform(result, "dtm")
            result = result.withColumn("semantic", array_to_vector("semantic"))
        sets = [name for name, used in self.use.items() if used]
        return combine_features(result, sets, sets)

    def names(self) -> list[str]:
        sizes = {}
        if self.use["statistical"]:
            sizes["stat"] = len(STATISTICS)
        if self.use["semantic"]:
            sizes["sem"] = self.lsa.components.shape[1]
        if self.use["topics"]:
            sizes["topic"] = self.topics
        return feature_names(sizes)


def nonzero_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns that hold a value other than 0 anywhere (B8): one pass, one row back."""
    row = df.agg(*[F.max(F.coalesce(F.col(c) != 0, F.lit(False))).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def align_columns(df: DataFrame, wanted: list[str], keep: list[str]) -> DataFrame:
    """Give the columns a model was trained on: missing ones as 0, others dropped, in order."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in have else F.lit(0.0).alias(c) for c in wanted])


def column_changes(df: DataFrame, wanted: list[str], keep: list[str]) -> dict[str, list[str]]:
    """Which columns the alignment adds and drops."""
    have = [c for c in df.columns if c not in keep]
    return {"missing": [c for c in wanted if c not in have], "extra": [c for c in have if c not in wanted]}


def vector_columns(df: DataFrame, vector: str, names: list[str], keep: list[str]) -> DataFrame:
    """A vector as one column per feature."""
    values = df.select(*keep, vector_to_array(vector).alias("_a"))
    return values.select(*keep, *[F.col("_a")[i].alias(name) for i, name in enumerate(names)])
