"""Queries of the operators on training data, one for each, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import exact_dedup, fp_search, minhash_join, mixing, packing, positional_index, prefix_trie, private_data
from ledgerlens.llm import sharding, substring_dedup, topk_search, toxicity, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


SQL["op1_exact_dedup"] = r"""
WITH flat AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM flat WINDOW same AS (PARTITION BY t)
"""


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file())


@query
def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


@query
def op5_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    mix = mixing.mixture(docs)
    placed = mixing.copies(docs.select("doc_id", "source", mixing.n_tokens("text").alias("n_tokens")), mix, block_tokens=1e6)
    return placed.select(
        "doc_id", "source", "n_tokens", F.col("_mix_epoch").alias("epoch"), F.col("_mix_block").alias("block"),
        F.col("_mix_place").alias("place"), F.col("_mix_weight").alias("weight"),
    )


@query
def op8_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


SQL["op8_exact_topk"] = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


@query
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages"), RULES)


@query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards_of(table(spark, folder, "documents"))


@query
def op7_private_data(spark: SparkSession, folder: str) -> DataFrame:
    return private_data.personal_data(table(spark, folder, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.removed(table(spark, folder, "documents")).drop("spans")


@query
def op13_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return positional_index.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


# Words of a text: runs of digits, letters and characters beyond ASCII, with A to Z lowered.
WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w"
)

SQL["op13_benchmark_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} FROM documents),
i AS (SELECT item_id, {WORDS_SQL} FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, l, array_to_string(w[p : p + l - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)
), places AS (
  SELECT r, p, l, array_to_string(w[p : p + l - 1], ' ') AS gram
  FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, (SELECT DISTINCT l FROM windows))
), hits AS (SELECT r, p, l, item_id FROM places JOIN windows USING (l, gram)),
hit_words AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + l)) AS q FROM hits) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(hit_words.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, hit_words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN named USING (r)
"""


@query
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return fp_search.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op11_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} FROM documents),
i AS (SELECT DISTINCT item_id, unnest(w) AS t FROM (SELECT item_id, {WORDS_SQL} FROM benchmark)),
tfs AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
size AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tfs, size GROUP BY t, n),
ms AS (SELECT r, doc_id, 100 - 50 + (50 * len(w) * n) // l AS m FROM d, size WHERE len(w) > 0),
scored AS (
  SELECT item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM i JOIN tfs USING (t) JOIN weights USING (t) JOIN ms USING (r) GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


# CRC-32 of the decimal id, bit by bit.
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

SQL["op12_prefix_trie"] = f"""
WITH filled AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (SELECT conv_id, turn, length(role) || ':' || role || text AS k, length(text) AS size FROM filled),
lists AS (
  SELECT conv_id, list(k ORDER BY turn NULLS FIRST, sha256(k)) AS ks, list(size ORDER BY turn NULLS FIRST, sha256(k)) AS ns FROM keyed GROUP BY conv_id
), hashed AS (SELECT *, {CRC_SQL} % 6 AS h FROM lists),
made AS (
  SELECT c.conv_id, list_concat(coalesce(b.ks[1:h], []), c.ks[h + 1:]) AS ks, list_concat(coalesce(b.ns[1:h], []), c.ns[h + 1:]) AS ns
  FROM hashed c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
  SELECT conv_id, d, ks[1:d] AS k, len(ks) = d AS last, coalesce(ns[d], 0) AS size FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM made)
), nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ends FROM prefixes GROUP BY k, d
), children AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
valued AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (k)),
totals AS (
  SELECT k[1:j] AS k, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM valued) GROUP BY 1
)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, leaves AS n_leaves,
  CAST(totals.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN totals USING (k) LEFT JOIN nodes p ON v.d > 0 AND p.k = v.k[1:v.d - 1]
"""
