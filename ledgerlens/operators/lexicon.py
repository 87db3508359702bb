"""Sentiment over tables: enriching rows, user lexicons in tables, counts from a term table, and plug-in scorers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.expr import as_column, let
from ledgerlens.functions.sentiment import SCORES, analyze, count_in, model_scores, score_struct
from ledgerlens.functions.text import text_chunks, word_tokens
from ledgerlens.functions.wordlists import LEXICON
from ledgerlens.operators.hot_join import HOT_TERMS, frequent_terms, join_terms
from ledgerlens.operators.sparse import cells
from ledgerlens.session import SMALL_TABLE_ROWS, small, stage


def lexicon_table(spark: SparkSession, lexicon: dict[str, list[str]] | None = None) -> DataFrame:
    """The lexicon as a table ``(category, term)``."""
    lexicon = LEXICON if lexicon is None else lexicon
    rows = [(category, term) for category, terms in lexicon.items() for term in terms]
    return spark.createDataFrame(rows, "category string, term string")


def enrich(df: DataFrame, text: str, prefix: str = "sentiment_") -> DataFrame:
    """Add the six scores as prefixed columns (C1, B11). The scores are computed in the row, so nothing is joined."""
    scored = df.withColumn("_scores", analyze(F.coalesce(F.col(text), F.lit(""))))
    return scored.select("*", *[F.col("_scores")[name].alias(prefix + name) for name in SCORES]).drop("_scores")


def attach_scores(df: DataFrame, scores: DataFrame, key: str, prefix: str = "sentiment_") -> DataFrame:
    """Attach scores that another job wrote, by key."""
    renamed = scores.withColumnsRenamed({c: prefix + c for c in scores.columns if c != key})
    return df.join(renamed, key, "left")


def lexicon_flags(lexicon: DataFrame) -> DataFrame:
    """One row per term with a flag per category, so that a term of two categories is met once."""
    flags = [F.max((F.col("category") == name).cast("int")).alias(name) for name in LEXICON]
    return lexicon.groupBy("term").agg(*flags)


def score_with_lexicon_table(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, limit: int = SMALL_TABLE_ROWS, most: int = HOT_TERMS
) -> DataFrame:
    """Scores from a lexicon table of any size (C2, D23): ``(key, six scores)``; a NULL text has no tokens.

    A lexicon of at most ``limit`` terms, which is checked, is broadcast: tokens meet it where they are, and only one partial
    sum per text is shuffled. Beyond it, the ``most`` frequent terms of the texts are counted in the row of their text, and
    only the other tokens are shuffled by term, so that no term brings a large share of all tokens to one task.
    """
    flags = lexicon_flags(lexicon)
    known = small(flags, limit)
    if known is not flags:
        tokens = df.select(key, F.explode_outer(word_tokens(text)).alias("term"))
        hits = tokens.withColumn("tf", F.col("term").isNotNull().cast("long")).join(known, "term", "left")
        return _scores_of_hits(hits, key)
    flags = stage(flags, "lexicon")
    hot = frequent_terms(df.select(F.explode(word_tokens(text)).alias("term")), "term", most)
    found = flags.where(F.col("term").isin(hot)).collect()  # at most ``most`` rows
    near = {name: [r["term"] for r in found if r[name]] for name in LEXICON}
    rest = rare_tokens(df, key, text, hot, near).join(flags, "term", "left")
    sums = [
        F.sum(F.coalesce(F.col("here")[name], F.lit(0)) + F.when(F.col("real"), F.coalesce(F.col(name), F.lit(0))).otherwise(0)).alias(name)
        for name in LEXICON
    ]
    totals = rest.groupBy(key).agg(*sums, F.sum(F.col("here")["total"]).alias("_total"))
    return _scores_of_totals(totals, key)


def rare_tokens(df: DataFrame, key: str, text: str, hot: list[str], near: dict[str, list[str]]) -> DataFrame:
    """Tokens that are not in ``hot``: ``(key, term, real, here)``.

    The first row of each text carries ``here``, the counts of the terms ``near`` by category and of all tokens. A text
    without other tokens keeps one row that is not ``real``, under a term of its own, so that such rows are spread.
    """

    def parts(words: Column) -> Column:
        counts = [count_in(words, terms).cast("long").alias(name) for name, terms in near.items()]
        rare = F.filter(words, lambda w: ~w.isin(hot)) if hot else words
        return F.struct(F.struct(*counts, F.size(words).cast("long").alias("total")).alias("here"), rare.alias("rare"))

    words = F.coalesce(word_tokens(text), F.array().cast("array<string>"))
    rows = df.select(key, let(words, parts).alias("p")).select(key, "p.here", F.posexplode_outer("p.rare").alias("at", "term"))
    own = F.concat(F.lit("\0"), F.xxhash64(key).cast("string"))
    first = F.when(F.coalesce(F.col("at"), F.lit(0)) == 0, F.col("here"))
    return rows.select(key, F.coalesce("term", own).alias("term"), F.col("term").isNotNull().alias("real"), first.alias("here"))


def scores_from_counts(
    counts: DataFrame, key: str, lexicon: DataFrame, limit: int = SMALL_TABLE_ROWS, most: int = HOT_TERMS
) -> DataFrame:
    """Scores from term counts ``(key, term, tf)``; the denominator is the counted terms only.

    Beyond ``limit`` terms the lexicon is joined by shuffle, but for the ``most`` frequent terms of the counts.
    """
    flags = lexicon_flags(lexicon)
    known = small(flags, limit)
    if known is not flags:
        return _scores_of_hits(counts.join(known, "term", "left"), key)
    return _scores_of_hits(join_terms(counts, stage(flags, "lexicon"), "term", frequent_terms(counts, "term", most)), key)


def _scores_of_hits(hits: DataFrame, key: str) -> DataFrame:
    sums = [F.sum(F.col("tf") * F.coalesce(F.col(name), F.lit(0))).alias(name) for name in LEXICON]
    return _scores_of_totals(hits.groupBy(key).agg(*sums, F.sum("tf").alias("_total")), key)


def _scores_of_totals(totals: DataFrame, key: str) -> DataFrame:
    scored = totals.select(key, score_struct({n: F.col(n) for n in LEXICON}, F.col("_total")).alias("s"))
    return scored.select(key, *[F.col("s")[name].alias(name) for name in SCORES])


def score_vectors(
    df: DataFrame, key: str, vector: str, vocabulary: list[str], lexicon: dict[str, list[str]] | None = None
) -> DataFrame:
    """Scores from the rows of a count matrix (D24): the cells of a batch of rows are summed at once, without a join."""
    lexicon = LEXICON if lexicon is None else lexicon
    position = {term: i for i, term in enumerate(vocabulary)}
    wanted = {name: [position[t] for t in terms if t in position] for name, terms in lexicon.items()}
    names = [*wanted, "total"]
    # A dense vector has no positions, and its row no scores.
    rows = cells(df.select(key, vector), vector).select(key, "i", F.when(F.col("i").isNotNull(), F.col("x")))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        member = np.zeros((len(vocabulary), len(wanted)), bool)
        for j, at in enumerate(wanted.values()):
            member[at, j] = True
        for batch in batches:
            lists, numbers = batch.column(1), batch.column(2)
            row = lists.value_parent_indices().to_numpy()
            column, value = lists.flatten().to_numpy(), numbers.flatten().to_numpy()
            empty = lists.is_null().to_numpy(zero_copy_only=False)
            sums = [np.bincount(row[of], value[of], len(lists)) for of in (*member[column].T, slice(None))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(s.astype(float), mask=empty) for s in sums]], [key, *names])

    types = ", ".join([f"`{key}` {df.schema[key].dataType.simpleString()}", *[f"`{n}` double" for n in names]])
    sums = rows.mapInArrow(run, types)
    scored = sums.select(key, score_struct({n: F.col(n) for n in wanted}, F.col("total")).alias("s"))
    return scored.select(key, *[F.col("s")[name].alias(name) for name in SCORES])


def sentiment_rows(scores: DataFrame, key: str) -> DataFrame:
    """Scores as rows ``(key, dimension, score)`` ranked by absolute value within each key (F1).

    The six scores of a row are sorted inside the row, so that no shuffle is needed.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(n).alias("score")) for n in SCORES])
    ranked = F.array_sort(
        pairs,
        lambda a, b: F.when(F.abs(a["score"]) > F.abs(b["score"]), -1)
        .when(F.abs(a["score"]) < F.abs(b["score"]), 1)
        .when(a["dimension"] < b["dimension"], -1)
        .when(a["dimension"] > b["dimension"], 1)
        .otherwise(0),
    )
    listed = scores.select(key, F.posexplode(ranked).alias("position", "pair"))
    return listed.select(
        key, (F.col("position") + 1).alias("rank"), F.col("pair.dimension"), F.col("pair.score").alias("score")
    )


def chunk_scores(
    df: DataFrame, key: str, text: str, positive: Callable[[Column], Column], negative: Callable[[Column], Column]
) -> DataFrame:
    """Mean score over the 512-character chunks of each text, for scorers that are column expressions.

    The mean is taken inside the row: the chunks of a text never leave it.
    """
    chunks = df.select(key, text_chunks(F.coalesce(as_column(text), F.lit(""))).alias("_chunks"))

    def mean(score: Callable[[Column], Column]) -> Column:
        total = F.aggregate(F.col("_chunks"), F.lit(0.0), lambda acc, chunk: acc + score(chunk))
        return total / F.size("_chunks")

    scored = chunks.select(
        key,
        F.size("_chunks").alias("chunks"),
        model_scores(mean(positive), mean(negative)).alias("s"),
    )
    return scored.select(key, "chunks", "s.*")


def plugin_scores(
    df: DataFrame, key: str, text: str, make_scorer: Callable[[], Callable[[list[str]], list[dict]]], batch: int = 32
) -> DataFrame:
    """Mean positive and negative score per text from a plug-in model (I8, K3).

    ``make_scorer`` runs once per task and returns a function from a list of chunks to a list of
    ``{"positive": .., "negative": ..}``. A chunk is one row, so a long text is spread over many batches. The chunk
    scores are averaged with a partial aggregation before the shuffle.
    """
    key_type = df.schema[key].dataType.simpleString()
    chunks = df.select(F.col(key).alias("key"), F.explode(text_chunks(F.coalesce(F.col(text), F.lit("")))).alias("c"))

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        scorer = make_scorer()
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                scores = scorer(part["c"].tolist())
                yield pd.DataFrame(
                    {
                        "key": part["key"].to_numpy(),
                        "positive": [float(s.get("positive", 0.0)) for s in scores],
                        "negative": [float(s.get("negative", 0.0)) for s in scores],
                    }
                )

    rows = chunks.mapInPandas(run, f"key {key_type}, positive double, negative double")
    means = rows.groupBy("key").agg(F.avg("positive").alias("positive"), F.avg("negative").alias("negative"))
    scored = means.select(F.col("key").alias(key), model_scores(F.col("positive"), F.col("negative")).alias("s"))
    return scored.select(key, "s.*")


def custom_analyzer(name: str, analyse: Callable[[str], dict], fields: list[str], spark: SparkSession):
    """Register a user analyser ``text -> dict`` as an Arrow-batched SQL function that returns a struct (K1, K2)."""

    @F.pandas_udf(", ".join(f"{f} double" for f in fields))
    def run(texts):
        import pandas as pd

        rows = [analyse(t) if isinstance(t, str) else {} for t in texts]
        return pd.DataFrame([{f: r.get(f) for f in fields} for r in rows], columns=fields).astype("float64")

    spark.udf.register(name, run)
    return run
