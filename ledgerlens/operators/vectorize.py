"""Document-term matrices and TF-IDF.

Only the vocabulary needs a shuffle. Once it is fitted (at most ``max_features`` terms), every document is counted in
its own row by Spark ML, so a matrix of any height is made by a map.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.text import MIN_TOKEN_LENGTH, WORD_CHARS, vocabulary_tokens, with_bigrams, word_count
from ledgerlens.functions.wordlists import ENGLISH_STOP_WORDS
from ledgerlens.session import stage

# Vocabulary limits.
MAX_FEATURES = 5000
MAX_DOC_FREQ = 0.95
METHODS = ("count", "tfidf")
# Hash buckets by which rare terms are summed, and the share of the documents from which frequent terms are guessed.
TERM_BUCKETS = 1 << 18
GUESS_SHARE = 0.01


def terms_of(text: Column | str, bigrams: bool = True) -> Column:
    """Terms of a text: vocabulary tokens without stop words, then pairs of neighbours."""
    tokens = vocabulary_tokens(text)
    return with_bigrams(tokens) if bigrams else tokens


def counted_terms(terms: DataFrame, share: float = 0.0) -> DataFrame:
    """Terms of the lists in column ``terms`` as rows ``(term, cf, df, picked)``, one for each batch of documents that holds the term.

    A task numbers the terms of a batch and counts the numbers, so that no row is made for each use of a term. ``picked`` is
    how often the term stands in a ``share`` of the batch, documents at even steps from the first.
    """
    step = round(1 / share) if share else 0

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            lists = batch.column(0)
            coded = lists.flatten().dictionary_encode()
            size = len(coded.dictionary)
            number = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            parent = pc.list_parent_indices(lists).to_numpy()[number >= 0]
            number = number[number >= 0]
            few = number[parent % step == 0] if step else number[:0]
            pairs = np.sort(parent * max(size, 1) + number)
            pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
            counts = [pa.array(np.bincount(n, minlength=size)) for n in (number, pairs % max(size, 1), few)]
            yield pa.RecordBatch.from_arrays([coded.dictionary, *counts], ["term", "cf", "df", "picked"])

    return terms.select("terms").mapInArrow(count, "term string, cf long, df long, picked long")


def frequencies() -> list[Column]:
    return [F.sum("cf").alias("cf"), F.sum("df").alias("df")]


def term_statistics(terms: DataFrame) -> DataFrame:
    """Corpus and document frequency of each term in column ``terms`` (D10, D11): ``(term, cf, df)``."""
    return counted_terms(terms).groupBy("term").agg(*frequencies())


def top_terms(stats: DataFrame, documents: int, max_features: int, max_df: float) -> DataFrame:
    """The most frequent terms that are in at most ``max_df`` of the documents (F9); ties go to the lower term."""
    kept = stats.where(F.col("df") <= max_df * documents)
    return kept.orderBy(F.desc("cf"), "term").limit(max_features)


def frequent_terms(
    terms: DataFrame, documents: int, max_features: int, max_df: float, buckets: int = TERM_BUCKETS, share: float = GUESS_SHARE
) -> DataFrame:
    """``top_terms`` of ``term_statistics``, exactly, without a shuffle of the rare terms (F9): ``(term, cf, df)``.

    The counts of each batch of documents are written, so that the texts are read once. Likely terms are guessed from a
    ``share`` of the documents, which is counted apart in the same pass. One pass over the counts sums those exactly, and all others only
    by hash bucket, so that a task gives at most ``2 * max_features`` + ``buckets`` rows. The least of the best counts found is
    a bound that no term of a bucket with a smaller sum can reach; a second pass counts the terms of the buckets that remain.
    The guess decides how many remain, not the result: with a bad one the second pass counts all terms. The tables that
    are broadcast hold at most ``2 * max_features`` terms and ``buckets`` numbers.
    """
    counts = stage(counted_terms(terms, share), "counts")
    seen = counts.where("picked > 0").groupBy("term").agg(F.sum("picked").alias("picked"))
    guess = seen.orderBy(F.desc("picked"), "term").limit(2 * max_features)
    guess = stage(guess.select("term", F.lit(True).alias("likely")), "likely")
    rows = counts.join(F.broadcast(guess), "term", "left")
    rows = rows.withColumn("bucket", F.when(F.col("likely").isNull(), F.pmod(F.xxhash64("term"), F.lit(buckets))))
    known = F.when(F.col("likely"), F.col("term"))
    sums = stage(rows.groupBy(known.alias("term"), "bucket").agg(*frequencies()), "sums")
    best = top_terms(sums.where("term is not null"), documents, max_features, max_df).agg(F.count("cf"), F.min("cf")).first()
    bound = best[1] if best[0] == max_features and max_features else 1
    left = sums.where(F.col("bucket").isNotNull() & (F.col("cf") >= bound)).select("bucket")
    recounted = rows.join(F.broadcast(left), "bucket", "left_semi").groupBy("term").agg(*frequencies())
    counted = sums.where("term is not null").select("term", "cf", "df").unionByName(recounted)
    return top_terms(counted, documents, max_features, max_df)


@dataclass(frozen=True)
class Vocabulary:
    """Terms in alphabetical order with the documents that hold them, and the number of all documents."""

    terms: list[str]
    document_frequency: list[int]
    documents: int
    bigrams: bool = True


@dataclass(frozen=True)
class FittedVectorizer:
    """A fitted vectoriser: an ML pipeline and its vocabulary."""

    model: PipelineModel
    vocabulary: list[str]
    text: str
    output: str

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the vector column; the vocabulary stays as fitted."""
        return self.model.transform(df).drop("_terms", "_counts", "_weighted")

    def long(self, df: DataFrame, key: str, value: str = "tf") -> DataFrame:
        """Non-zero cells ``(key, term, value)``."""
        return vector_cells(self.transform(df), key, self.output, self.vocabulary, value)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @staticmethod
    def load(path: str) -> FittedVectorizer:
        model = PipelineModel.load(path)
        counter = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
        first = model.stages[0].getStatement()
        text = first.split("/*", 1)[1].split("*/", 1)[0].strip()
        return FittedVectorizer(model, counter.vocabulary, text, model.stages[-1].getOutputCol())


def terms_statement(text: str, bigrams: bool) -> str:
    """The same terms as ``terms_of``, as a statement that an ML pipeline can store."""
    stop = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS if "'" not in w)
    pattern = rf"(?<![{WORD_CHARS}])[a-z_]{{{MIN_TOKEN_LENGTH},}}(?![{WORD_CHARS}])"
    tokens = f"filter(regexp_extract_all(lower(coalesce(`{text}`, '')), r'{pattern}', 0), w -> w NOT IN ({stop}))"
    if not bigrams:
        return f"SELECT /* {text} */ *, {tokens} AS _terms FROM __THIS__"
    pairs = (
        "concat(t, zip_with(slice(t, 1, greatest(size(t) - 1, 0)), slice(t, 2, greatest(size(t) - 1, 0)), "
        "(a, b) -> concat_ws(' ', a, b)))"
    )
    return f"SELECT /* {text} */ *, get(transform(array({tokens}), t -> {pairs}), 0) AS _terms FROM __THIS__"


def fit_vectorizer(
    df: DataFrame,
    text: str,
    method: str = "count",
    max_features: int = MAX_FEATURES,
    bigrams: bool = True,
    max_df: float = MAX_DOC_FREQ,
    output: str = "vector",
) -> FittedVectorizer:
    """Fit the vocabulary and give a count or TF-IDF vectoriser.

    TF-IDF uses the smoothed weight ``ln((1 + n) / (1 + df)) + 1`` and rows of length 1. The vocabulary is in
    alphabetical order.
    """
    if method not in METHODS:
        raise ValueError(f"unknown vectorisation method: {method}")
    return vectorizer(fit_vocabulary(df, text, max_features, bigrams, max_df), text, method, output)


def fit_vocabulary(
    df: DataFrame, text: str, max_features: int = MAX_FEATURES, bigrams: bool = True, max_df: float = MAX_DOC_FREQ
) -> Vocabulary:
    """The one step that shuffles: count the frequent terms and keep the best ``max_features``, in alphabetical order."""
    documents = df.count()
    terms = df.select(terms_of(F.coalesce(F.col(text), F.lit("")), bigrams).alias("terms"))
    # Bounded by max_features.
    rows = sorted(frequent_terms(terms, documents, max_features, max_df).collect(), key=lambda r: r["term"])
    if not rows:
        raise ValueError("no terms remain after the vocabulary limits")
    return Vocabulary([r["term"] for r in rows], [r["df"] for r in rows], documents, bigrams)


def vectorizer(vocabulary: Vocabulary, text: str, method: str = "count", output: str = "vector") -> FittedVectorizer:
    """Count or TF-IDF vectoriser over a fitted vocabulary; several may share one."""
    if method not in METHODS:
        raise ValueError(f"unknown vectorisation method: {method}")
    terms = SQLTransformer(statement=terms_statement(text, vocabulary.bigrams))
    if method == "count":
        counter = CountVectorizerModel.from_vocabulary(vocabulary.terms, inputCol="_terms", outputCol=output)
        stages = [terms, counter]
    else:
        counter = CountVectorizerModel.from_vocabulary(vocabulary.terms, inputCol="_terms", outputCol="_counts")
        idf = [math.log((1 + vocabulary.documents) / (1 + n)) + 1 for n in vocabulary.document_frequency]
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_weighted")
        stages = [terms, counter, weigh, Normalizer(p=2.0, inputCol="_weighted", outputCol=output)]
    return FittedVectorizer(PipelineModel(stages), vocabulary.terms, text, output)


def vector_cells(df: DataFrame, key: str, vector: str, names: list[str], value: str) -> DataFrame:
    """Sparse vectors as rows ``(key, term, value)`` (C6). The names are at most one per vector position."""
    sparse = df.select(key, F.unwrap_udt(vector).alias("v"))
    cells = sparse.select(key, F.inline(F.arrays_zip(F.col("v.indices").alias("i"), F.col("v.values").alias("x"))))
    terms = df.sparkSession.createDataFrame(list(enumerate(names)), "i int, term string")
    return cells.join(F.broadcast(terms), "i").select(key, "term", F.col("x").alias(value))


def matrix_statistics(df: DataFrame, vectorizer: FittedVectorizer) -> DataFrame:
    """Word counts, documents, vocabulary size and density of the matrix, in one pass."""
    size = len(vectorizer.vocabulary)
    filled = vectorizer.transform(df).select(
        word_count(vectorizer.text).alias("words"), F.size(F.unwrap_udt(vectorizer.output)["indices"]).alias("n")
    )
    return filled.agg(
        F.avg("words").alias("mean_length"),
        F.median("words").alias("median_length"),
        F.min("words").alias("min_length"),
        F.max("words").alias("max_length"),
        F.count(F.lit(1)).alias("total_documents"),
        F.lit(size).alias("vocabulary_size"),
        F.try_divide(F.sum("n"), F.count(F.lit(1)) * size).alias("density"),
    )
