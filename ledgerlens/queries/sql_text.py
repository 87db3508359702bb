"""SQL fragments shared by the check queries."""

from __future__ import annotations

from ledgerlens.functions.text import BOILERPLATE
from ledgerlens.functions.wordlists import ENGLISH_STOP_WORDS, LEXICON

WORD = r"[\p{L}\p{N}_]+"
SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def words(col: str) -> str:
    return f"regexp_extract_all(lower({col}), '{WORD}')"


def vocabulary(col: str) -> str:
    stop = quoted([w for w in ENGLISH_STOP_WORDS if "'" not in w])
    return (
        f"list_filter({words(col)}, lambda w: regexp_full_match(w, '[a-z_]{{3,}}') AND w NOT IN ({stop}))"
    )


def word_count(col: str) -> str:
    return f"len(regexp_extract_all({col}, '[^{SPACE}]+'))"


def sentences(col: str) -> str:
    return (
        f"list_filter(string_split(regexp_replace({col}, '([.!?])[{SPACE}]+', '\\1' || chr(1), 'g'), chr(1)), "
        "lambda s: s <> '')"
    )


def hits(col: str, category: str) -> str:
    return f"len(list_filter({col}, lambda w: w IN ({quoted(LEXICON[category])})))"


def scores_table(source: str, key: str, text: str, name: str = "scores", keep: str = "") -> str:
    """Named table with the six lexicon scores of each row."""
    counts = ", ".join(f"{hits('w', c)} AS n_{c}" for c in LEXICON)
    shares = ", ".join(f"n_{c} / total AS {c}" for c in LEXICON)
    return f"""
{name}_words AS (SELECT {key}{keep}, {words(text)} AS w FROM {source}),
{name}_counts AS (SELECT {key}{keep}, greatest(len(w), 1)::DOUBLE AS total, {counts} FROM {name}_words),
{name} AS (
  SELECT {key}{keep}, {shares}, (n_positive - n_negative) / total AS net_sentiment,
    n_positive / (n_negative + 1)::DOUBLE AS sentiment_ratio
  FROM {name}_counts
)"""


SCORES = ["positive", "negative", "uncertainty", "litigious", "net_sentiment", "sentiment_ratio"]


def rounded(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


GOOD_SENTENCE = (
    f"(len(regexp_extract_all(s, '[^{SPACE}]+')) BETWEEN 5 AND 100 AND NOT regexp_matches(lower(s), '{BOILERPLATE}'))"
)


def replaced_numbers(col: str) -> str:
    scale = r"(?:\s*(?:million|billion|m|b|k|thousand))?\b"
    money = rf"(?i)\$\s*\d+(?:\.\d+)?{scale}"
    number = rf"(?i)\b\d+(?:\.\d+)?{scale}"
    step = f"regexp_replace({col}, '{money}', ' financial_number ', 'g')"
    step = f"regexp_replace({step}, '\\d+(?:\\.\\d+)?%', ' percentage_number ', 'g')"
    return f"regexp_replace({step}, '{number}', ' number ', 'g')"


def cleaned(col: str) -> str:
    return f"trim(regexp_replace(lower({col}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"


def filtered(col: str) -> str:
    return f"array_to_string(list_filter({sentences(col)}, lambda s: {GOOD_SENTENCE}), ' ')"


def cleaned_sentences(col: str) -> str:
    breaks = rf"(?:[{SPACE};@#$%&?!()\[\]{{}}<>\"“”‘’«»„`:,]|--|\.\.\.)+"
    numbered = f"regexp_replace({col}, '\\$?\\d+(?:,\\d{{3}})*(?:\\.\\d+)?', ' financial_number ', 'g')"
    plain = (
        f"regexp_replace({numbered}, '(?i)(?:n''t|''(?:ll|re|ve|s|m|d)?)([{SPACE};?!()\",:.]|$)', '\\1', 'g')"
    )
    tokens = (
        "list_transform(list_filter(regexp_split_to_array(regexp_replace(s, '\\.[\"'')\\]}>»”’ ]*$', ''), "
        f"'{breaks.replace(chr(39), chr(39) * 2)}'), "
        "lambda t: regexp_full_match(t, 'financial_number|\\p{L}{3,}')), lambda t: lower(t))"
    )
    lists = f"list_transform({sentences(plain)}, lambda s: {tokens})"
    kept = (
        f"list_filter({lists}, lambda ts: len(ts) >= 5 "
        "AND len(list_filter(ts, lambda t: t = 'financial_number')) / len(ts) <= 0.4)"
    )
    return f"coalesce(array_to_string(flatten({kept}), ' '), '')"
