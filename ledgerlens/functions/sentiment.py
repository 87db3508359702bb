"""Sentiment scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.expr import as_column, let
from ledgerlens.functions.text import vocabulary_tokens, word_tokens
from ledgerlens.functions.wordlists import LEXICON

SCORES = ["positive", "negative", "uncertainty", "litigious", "net_sentiment", "sentiment_ratio"]

# Smoothing terms of the two sentiment ratios, and the class limits.
LEXICON_RATIO_OFFSET = 1
MODEL_RATIO_OFFSET = 0.001
POLARITY_LIMIT = 0.1
SUMMARY_LIMIT = 0.2


def count_in(words: Column, terms: list[str]) -> Column:
    return F.size(F.filter(words, lambda word: word.isin(terms)))


def score_struct(counts: dict[str, Column], total: Column) -> Column:
    """Six scores from four category counts and the number of tokens."""
    base = F.greatest(total, F.lit(1)).cast("double")
    shares = {name: (count / base).alias(name) for name, count in counts.items()}
    net = ((counts["positive"] - counts["negative"]) / base).alias("net_sentiment")
    ratio = (counts["positive"] / (counts["negative"] + LEXICON_RATIO_OFFSET)).cast("double").alias("sentiment_ratio")
    return F.struct(*[shares[name] for name in SCORES[:4]], net, ratio)


def lexicon_scores(
    text: Column | str, lexicon: dict[str, list[str]] | None = None, vocabulary_only: bool = False
) -> Column:
    """Lexicon scores of a text, computed in its own row: no join and no shuffle.

    Each category is a hash set inside the expression, which suits the built-in lists. A large user lexicon belongs in
    a table; see ``operators.lexicon.score_with_lexicon_table``.
    """
    lexicon = LEXICON if lexicon is None else lexicon
    tokens = vocabulary_tokens(text, []) if vocabulary_only else word_tokens(text)

    def scores(words: Column) -> Column:
        counts = {name: count_in(words, terms) for name, terms in lexicon.items()}
        return score_struct(counts, F.size(words))

    return let(tokens, scores)


def is_blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(r"[^\t-\r\x1c-\x20\x85\p{Z}]")


def analyze(text: Column | str, lexicon: dict[str, list[str]] | None = None) -> Column:
    """Lexicon scores; blank text gets 0 / 0 / 0 / 1 and no uncertainty or litigious score."""
    col = as_column(text)
    nothing = F.lit(None).cast("double")
    values = [F.lit(0.0), F.lit(0.0), nothing, nothing, F.lit(0.0), F.lit(1.0)]
    default = F.struct(*[value.alias(name) for name, value in zip(SCORES, values)])
    return F.when(is_blank(col), default).otherwise(lexicon_scores(col, lexicon))


def model_scores(positive: Column, negative: Column) -> Column:
    """Net score and ratio from the class scores of a model."""
    return F.struct(
        positive.alias("positive"),
        negative.alias("negative"),
        (positive - negative).alias("net_sentiment"),
        (positive / (negative + MODEL_RATIO_OFFSET)).alias("sentiment_ratio"),
    )


def combine_scores(lexicon: Column, model: Column) -> Column:
    """Prefer the polarity of a model and fall back on the lexicon where the model gave nothing."""
    from_model = {"positive", "negative", "net_sentiment", "sentiment_ratio"}
    fields = [
        (F.coalesce(model[name], lexicon[name]) if name in from_model else lexicon[name]).alias(name)
        for name in SCORES
    ]
    return F.struct(*fields)


def sentiment_class(score: Column | str, limit: float = POLARITY_LIMIT) -> Column:
    """Positive above the limit, Negative below its opposite, else Neutral (H19; H20 with ``SUMMARY_LIMIT``)."""
    col = as_column(score)
    return F.when(col > limit, "Positive").when(col < -limit, "Negative").otherwise("Neutral")


def normalised_polarity(positive: Column, neutral: Column, negative: Column, net: Column) -> Column:
    """Shares of positive, neutral and negative that sum to 1; the net score stands in when all are 0."""
    flat = (positive == 0) & (neutral == 0) & (negative == 0)
    pos = F.when(flat & (net > 0), net).otherwise(positive)
    neg = F.when(flat & (net < 0), F.abs(net)).otherwise(negative)
    neu = F.when(flat & (net == 0), F.lit(1.0)).otherwise(neutral)
    total = pos + neu + neg

    def share(value: Column) -> Column:
        return F.when(total > 0, F.try_divide(value, total)).otherwise(value)

    return F.struct(share(pos).alias("positive"), share(neu).alias("neutral"), share(neg).alias("negative"))
