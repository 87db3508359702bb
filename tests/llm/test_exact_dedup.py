import re
from hashlib import sha256

from pyspark.sql import functions as F

from ledgerlens.llm.exact_dedup import exact_duplicates, keep_first

SCHEMA = "doc_id bigint, text string, keep_id string, recipe int"
LONG = "Some words, and then more of them; " * 900
ROWS = [
    (3, "a  b\tc", "x", 1), (1, "a b c", None, 2), (2, "a b c ", "x", 3), (9, None, None, None), (7, "", None, 1), (8, " \n", None, 1),
    (4, LONG, None, 1), (5, LONG.replace(" ", "  "), None, 1), (6, LONG + "!", None, 1), (1, "a b c", None, 2), (None, "a b c", None, 1),
    (None, "alone", None, 1), (11, "\u0000", "x", 1), (12, "ab\U0001f600", "y", 2), (13, "ab\U0001f600", "y", 2), (14, "x" * 9000, "", 0),
]


def brute(rows):
    seen = {}
    for doc_id, text, *_ in rows:
        flat = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        seen.setdefault(flat, []).append(doc_id)
    out = []
    for flat, ids in seen.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha256(flat.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    found = exact_duplicates(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(ROWS)


def test_names_that_stand_for_several_contents_are_told_apart(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = exact_duplicates(docs, name=lambda c: F.length(c) % 3).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(ROWS)


def test_kept_rows_are_whole_and_single(spark):
    kept = keep_first(spark.createDataFrame(ROWS, SCHEMA))
    assert kept.columns == ["doc_id", "text", "keep_id", "recipe"]
    want = sorted({(i, t, k, r) for i, t, k, r in ROWS if i in (1, 2, 7, 8, 4, 6, 11, 12, 14) or t == "alone"}, key=repr)
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == want


def test_columns_of_any_name_are_kept(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("_text_sha256", F.lit("mine")).withColumn("_id", F.lit(1))
    kept = keep_first(docs)
    assert kept.columns == docs.columns and {r["_text_sha256"] for r in kept.collect()} == {"mine"}


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert keep_first(spark.createDataFrame([], SCHEMA)).count() == 0
