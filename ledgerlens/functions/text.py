"""Text cleaning and tokenising as column expressions: no Python worker, no shuffle.

Every function takes a column (or its name) and returns a column. NULL text stays NULL unless the docstring says
otherwise. Letters and digits are Unicode letters and digits; white space is Unicode white space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.expr import as_column, let
from ledgerlens.functions.wordlists import ENGLISH_STOP_WORDS, STOP_WORDS

# Limits of the sentence and token filters.
MIN_TOKEN_LENGTH = 3
MIN_SENTENCE_TOKENS = 5
MAX_SENTENCE_WORDS = 100
MAX_NUMBER_SHARE = 0.4

# Character classes. A word character is a letter, a digit or an underscore.
WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"

# Number formats, in the order in which they are replaced. The explicit boundaries mean the same in
# every Java version; \b does not.
_SCALE = r"(?:\s*(?:million|billion|m|b|k|thousand))?"
_END = rf"(?![{WORD_CHARS}])"
_START = rf"(?<![{WORD_CHARS}])"
MONEY_PATTERN = rf"(?i)\$\s*\d+(?:\.\d+)?{_SCALE}{_END}"
PERCENT_PATTERN = r"\d+(?:\.\d+)?%"
NUMBER_PATTERN = rf"(?i){_START}\d+(?:\.\d+)?{_SCALE}{_END}"
GROUPED_MONEY_PATTERN = rf"(?i)\$\s*\d{{1,3}}(?:,\d{{3}})+(?:\.\d+)?{_SCALE}{_END}"
PLAIN_NUMBER_PATTERN = r"\$?\d+(?:,\d{3})*(?:\.\d+)?"

# Phrases that mark a sentence as boilerplate.
BOILERPLATE_PATTERNS = [
    r"safe harbor",
    r"forward-looking statement",
    r"non-gaap|non gaap",
    r"investor relations",
    r"www\.[a-zA-Z0-9-]+\.com",
    r"securities act",
    r"securities and exchange commission",
    r"for further information",
]
BOILERPLATE = "|".join(BOILERPLATE_PATTERNS)

# What separates the words of one sentence, and the endings split off a word (don't -> do).
WORD_BREAKS = rf"(?:[{SPACE_CHARS};@#$%&?!()\[\]{{}}<>\"“”‘’«»„`:,]|--|\.\.\.)+"
CONTRACTION_END = rf"(?i)(?:n't|'(?:ll|re|ve|s|m|d)?)(?=[{SPACE_CHARS};?!()\",:.]|$)"
FINAL_STOP = r"\.[\"')\]}>»”’ ]*$"


def replace_financial_numbers(text: Column | str, commas: bool = False) -> Column:
    """Replace amounts of money, percentages and other numbers by tokens (H1).

    ``commas=True`` also takes ``$1,234.56`` as one amount; by default the comma ends the number.
    """
    col = as_column(text)
    if commas:
        col = F.regexp_replace(col, GROUPED_MONEY_PATTERN, " financial_number ")
    col = F.regexp_replace(col, MONEY_PATTERN, " financial_number ")
    col = F.regexp_replace(col, PERCENT_PATTERN, " percentage_number ")
    return F.regexp_replace(col, NUMBER_PATTERN, " number ")


def split_sentences(text: Column | str) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space (H2); empty text has no sentence."""
    pieces = F.split(as_column(text), rf"(?<=[.!?])[{SPACE_CHARS}]+")
    return F.filter(pieces, lambda s: s != "")


def word_count(text: Column | str) -> Column:
    """Number of white-space separated words (H28); NULL text has none."""
    return F.coalesce(F.regexp_count(as_column(text), F.lit(rf"[^{SPACE_CHARS}]+")), F.lit(0))


def is_good_sentence(
    sentence: Column, min_words: int = MIN_SENTENCE_TOKENS, max_words: int = MAX_SENTENCE_WORDS
) -> Column:
    """Length and boilerplate test for one sentence."""
    return word_count(sentence).between(min_words, max_words) & ~F.lower(sentence).rlike(BOILERPLATE)


def filter_bad_sentences(
    text: Column | str, min_words: int = MIN_SENTENCE_TOKENS, max_words: int = MAX_SENTENCE_WORDS
) -> Column:
    """Keep the good sentences, joined by one space (H3)."""
    kept = F.filter(split_sentences(text), lambda s: is_good_sentence(s, min_words, max_words))
    return F.array_join(kept, " ")


def removed_share(
    text: Column | str, min_words: int = MIN_SENTENCE_TOKENS, max_words: int = MAX_SENTENCE_WORDS
) -> Column:
    """Share of sentences that the sentence filter removes, in percent (D12); 0 for a text without sentences."""

    def share(sentences: Column) -> Column:
        removed = F.size(F.filter(sentences, lambda s: ~is_good_sentence(s, min_words, max_words)))
        return F.when(F.size(sentences) > 0, removed / F.size(sentences) * 100).otherwise(F.lit(0.0))

    return let(split_sentences(text), share)


def clean_text(text: Column | str) -> Column:
    """Lower-case and reduce every run of other than word characters to one space (H4)."""
    return F.trim(F.regexp_replace(F.lower(as_column(text)), rf"[^{WORD_CHARS}]+", " "))


def sentence_tokens(sentence: Column) -> Column:
    """Kept words of one sentence, lower-cased: the number token and alphabetic words of 3 letters or more."""
    words = F.split(F.regexp_replace(sentence, FINAL_STOP, ""), WORD_BREAKS)
    kept = F.filter(words, lambda w: w.rlike(rf"^(?:financial_number|\p{{L}}{{{MIN_TOKEN_LENGTH},}})$"))
    return F.transform(kept, F.lower)


def is_wordy(tokens: Column) -> Column:
    """At least 5 tokens, of which at most 40 % are numbers."""
    numbers = F.size(F.filter(tokens, lambda t: t == "financial_number"))
    return (F.size(tokens) >= MIN_SENTENCE_TOKENS) & (numbers / F.size(tokens) <= MAX_NUMBER_SHARE)


def clean_sentences(text: Column | str) -> Column:
    """Numbers to tokens, then keep the words of wordy sentences (H5); NULL gives an empty string."""
    numbered = F.regexp_replace(as_column(text), PLAIN_NUMBER_PATTERN, " financial_number ")
    sentences = split_sentences(F.regexp_replace(numbered, CONTRACTION_END, ""))
    token_lists = F.filter(F.transform(sentences, sentence_tokens), is_wordy)
    return F.coalesce(F.array_join(F.flatten(token_lists), " "), F.lit(""))


def tokenize_text(text: Column | str, remove_stopwords: bool = True) -> Column:
    """White-space tokens, by default without stop words (H6, C3, case-sensitive); NULL gives an empty array."""
    tokens = F.regexp_extract_all(as_column(text), F.lit(rf"[^{SPACE_CHARS}]+"), F.lit(0))
    if remove_stopwords:
        tokens = F.filter(tokens, lambda t: ~t.isin(STOP_WORDS))
    return F.coalesce(tokens, F.array().cast("array<string>"))


def process_text(
    text: Column | str,
    replace_numbers: bool = True,
    filter_bad: bool = True,
    clean: bool = True,
    tokenize: bool = False,
    remove_stopwords: bool = True,
) -> Column:
    """Configurable chain of the steps above (H7)."""
    col = as_column(text)
    if replace_numbers:
        col = replace_financial_numbers(col)
    if filter_bad:
        col = filter_bad_sentences(col)
    if clean:
        col = clean_text(col)
    return tokenize_text(col, remove_stopwords) if tokenize else col


def word_tokens(text: Column | str) -> Column:
    """All word runs, lower-cased."""
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(rf"[{WORD_CHARS}]+"), F.lit(0))


def vocabulary_tokens(text: Column | str, stop_words: list[str] | None = None) -> Column:
    """Lower-cased words that consist of 3 or more ASCII letters or underscores (H10), without stop words."""
    stop_words = ENGLISH_STOP_WORDS if stop_words is None else stop_words
    pattern = rf"(?<![{WORD_CHARS}])[a-z_]{{{MIN_TOKEN_LENGTH},}}(?![{WORD_CHARS}])"
    tokens = F.regexp_extract_all(F.lower(as_column(text)), F.lit(pattern), F.lit(0))
    return F.filter(tokens, lambda t: ~t.isin(stop_words)) if stop_words else tokens


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by all pairs of neighbours."""

    def grams(words: Column) -> Column:
        pairs = F.greatest(F.size(words) - 1, F.lit(0))
        left, right = F.slice(words, 1, pairs), F.slice(words, 2, pairs)
        return F.concat(words, F.zip_with(left, right, lambda a, b: F.concat_ws(" ", a, b)))

    return let(tokens, grams)


def text_chunks(text: Column | str, size: int = 512) -> Column:
    """Cut text into pieces of ``size`` characters (H17); empty text is one empty piece."""
    col = as_column(text)
    starts = F.sequence(F.lit(1), F.greatest(F.length(col), F.lit(1)), F.lit(size))
    return F.transform(starts, lambda start: F.substring(col, start, F.lit(size)))


def preview(text: Column | str, chars: int = 100) -> Column:
    """First characters of a text, for display (F8)."""
    return F.substring(as_column(text), 1, chars)
