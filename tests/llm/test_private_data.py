import re
from hashlib import sha256

import duckdb
import pytest

from ledgerlens.llm.private_data import personal_data

SCHEMA = "doc_id bigint, text string, spans string, pattern string, value int"
NAMES = ["email", "ip", "card", "phone"]
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    found = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = [True, all(int(p) <= 255 for p in m[0].split(".")) if k == 1 else True, 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15][k]
            if ok:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def written(spans):
    return ",".join(f"{[*NAMES, 'id'][k]}:{a}:{b}" for a, k, b in spans)


TEXTS = [
    None, "", " \n", "a@b.c_d@e.f x@y z@@a.b a@b@c.d-e.f.", "mail ü\U0001f600 joe.doe+x@mail.example.com, 10.0.0.1 and 256.1.1.1 or 1.2.3.4.5.6.7.8 0001.02.3.255",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 4539148803436467 +1 (389) 555-5010, +49 30 1234567 +12", " a@b.co  1.1.1.1",
    "a" * 60000, "1." * 30000, "a.a@" * 3000 + "a.b", "+1 " + " " * 50000, "4111 1111 1111 1111 " * 700, "x@" + "a." * 20000 + "b",
]


def test_base_equals_regular_expressions(spark):
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x", "y", 1), (4, "other 1.2.3.4", "x", "y", 1), (None, "1.2.3.4", None, None, None)]
    found = personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    want = []
    for i, t, *_ in rows:
        spans = base(t)
        counts = [sum(k == n for _, k, _ in spans) for n in range(4)]
        want.append((i, *counts, sha256(written(spans).encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in found), key=repr) == sorted(want, key=repr)
    assert all(r["n_id"] == 0 for r in found)


def test_documents_of_the_test_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = {r["doc_id"]: r for r in personal_data(docs).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet'").fetchall()
    assert len(found) == len(rows)
    for i, text in rows:
        assert set(written(base(text)).split(",")) <= set(found[i]["spans"].split(",")) | {""}
        assert found[i]["base_sha256"] == sha256(written(base(text)).encode()).hexdigest()


@pytest.mark.parametrize("others", [0, 40])
def test_patterns_of_seeds_discover_identifiers(spark, others):
    rows = [(i, f"word please write to joe{i}@mail{i}.example.com now", "", "", 0) for i in range(12)]
    rows += [(50, "Somebody may WRITE  TO (user#4471), he said", "", "", 0), (51, "at 4471 nothing", "", "", 0)]
    rows += [(100 + i, f"they write to number{i}", "", "", 0) for i in range(others)]
    found = {r["doc_id"]: r for r in personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    if others:  # the words stand before anything
        assert all(r["n_id"] == 0 for r in found.values())
    else:
        assert found[50]["spans"] == "id:24:33" and found[50]["n_id"] == 1 and found[51]["n_id"] == 0


def test_empty_table(spark):
    assert personal_data(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "front,quote",
    [("no 4471 mail: ", ""), ("4471 " + " " * 200 + "mail: ", ""), ("x" * 100 + "7 mail: ", ""), ("y" * 300 + " mail: ", ""), ("1.1.1.1 2.2.2.2 to: ", "(")],
)
def test_context_is_the_same_for_seeds_and_candidates(spark, front, quote):
    """A number, many blanks or a long word stand in front of the last word."""
    rows = [(i, f"text {i} {front}{quote}joe{i}@mail{i}.example.com now", "", "", 0) for i in range(12)]
    rows += [(50, f"text 9 {front}{quote}user#77 now", "", "", 0), (51, f"text 9 other{front}user#78", "", "", 0)]
    rows += [(52, f"text 9 {front.replace('mail', 'post').replace('to', 'at')}user#79", "", "", 0)]
    found = {r["doc_id"]: r for r in personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    start = len(f"text 9 {front}{quote}")
    assert f"id:{start}:{start + 7}" in found[50]["spans"].split(",")
    assert "id" not in found[52]["spans"]


def test_words_before_follow_the_text(spark):
    """Across more pieces than a group holds, the last words are those of the whole text."""
    import random

    from pyspark.sql import functions as F

    from ledgerlens.llm.private_data import words_before

    rng = random.Random(8)
    lists = [["".join(rng.choices("ab1 \n", weights=[4, 4, 2, 2, 1], k=rng.randrange(0, 9))) for _ in range(n)] for n in (1, 3, 499, 1203)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(lists)], "i int, p array<string>")
    for row in df.select("i", words_before(F.col("p")).alias("w")).collect():
        text = ""
        for piece, got in zip(lists[row["i"]], row["w"], strict=True):
            text += piece
            assert got.split() == text.split()[-3:] and (got[-1:] == " ") == (text[-1:].isspace() and bool(text.split()))
