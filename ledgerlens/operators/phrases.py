"""Phrase tables of any size against texts: which phrases a text contains, found by one walk over the text."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.signals import MAX_RELEVANCE, MIN_KEYWORD_HITS, RELEVANCE_PER_HIT
from ledgerlens.session import stage

# Bytes of the phrases that are fetched and given to each task at once; an automaton takes some 40 bytes for each of them.
SLICE_BYTES = 8_000_000


def phrase_hits(df: DataFrame, key: str, text: str, phrases: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """How many different phrases of each category a lower-cased text contains (C8, C10): ``(key, category, hits)``, no zeros.

    ``phrases`` has a string ``phrase``, which is looked for as it stands, also inside words, and a string ``category``; NULL
    phrases and categories and repeated rows count for nothing. A NULL text contains nothing, and the empty phrase is in every
    other text. The hits of rows with the same key are added.

    Phrases beyond ``slice_bytes`` are dealt to slices by their hash, and the texts are read once for each slice; a phrase longer than
    ``slice_bytes`` makes its slice as much longer. Only hits are shuffled.
    """
    table = stage(phrases.select("category", "phrase").where("category is not null and phrase is not null").distinct(), "phrases")
    size = table.agg(F.sum(F.octet_length("phrase") + F.octet_length("category"))).first()[0] or 0
    # Slices of half the bound, because a hash does not deal evenly.
    slices = 1 if size <= slice_bytes else -(-2 * size // slice_bytes)
    texts = df.select(F.col(key).alias("key"), F.lower(text).alias("text")).where("text is not null")
    schema = f"key {texts.schema['key'].dataType.simpleString()}, category string, hits long"
    found = None
    for number in range(slices):
        part = table.where(F.pmod(F.xxhash64("phrase"), F.lit(slices)) == number)
        rows = part.groupBy("phrase").agg(F.sort_array(F.collect_set("category")).alias("categories")).collect()
        hits = texts.mapInArrow(_matcher(df.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])), schema)
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy(F.col("key").alias(key), "category").agg(F.sum("hits").alias("hits"))


def phrase_topics(df: DataFrame, key: str, text: str, phrases: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Topics of texts from a table of keywords, by the rule of ``signals.keyword_topics``."""
    hits = phrase_hits(df, key, text, phrases, slice_bytes).where(F.col("hits") >= MIN_KEYWORD_HITS)
    return hits.withColumn("relevance", F.least(F.lit(MAX_RELEVANCE), F.col("hits") * F.lit(RELEVANCE_PER_HIT)))


def _matcher(phrases):
    """Task over batches ``(key, text)``; its automaton is built once from the phrases and their categories."""

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import ahocorasick
        import pyarrow as pa

        finder, always = ahocorasick.Automaton(), Counter()
        for number, (phrase, categories) in enumerate(phrases.value):
            if phrase:
                finder.add_word(phrase, number)
            else:
                always.update(categories)
        finder.make_automaton()
        for batch in batches:
            at, names, hits = [], [], []
            for i, text in enumerate(batch.column(1)):
                own = Counter(always)
                if len(finder):
                    for number in {n for _, n in finder.iter(text.as_py())}:
                        own.update(phrases.value[number][1])
                at += [i] * len(own)
                names += own.keys()
                hits += own.values()
            keys = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(names, pa.string()), pa.array(hits, pa.int64())], ["key", "category", "hits"])

    return run
