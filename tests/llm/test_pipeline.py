import re
from collections import Counter

import pytest

import corpus_pipeline
from ledgerlens.llm import registered
from tests.llm.test_minhash_join import brute as near_brute


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    """Rows of documents and of each stage, written and read like run() does."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = [docs]
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, data).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs)
    return [[r.asDict() for r in df.collect()] for df in out], [df.columns for df in out]


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_names_and_columns(stages):
    _, columns = stages
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "MinHash near-dedup", "mixing sources", "best-fit packing"]
    assert all(c == columns[0] for c in columns[:-1])


def test_toxicity_rejects_what_the_query_predicts(spark, data, stages):
    rows, _ = stages
    predicted = {r["doc_id"] for r in registered.QUERIES["op2_toxicity"](spark, data).filter("predicted = 1").collect()}
    assert set(texts(rows[1])) == set(texts(rows[0])) - predicted


def test_exact_copies_leave_one(stages):
    rows, _ = stages
    first = {}
    for i, t in sorted(texts(rows[1]).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    assert sorted(r["doc_id"] for r in rows[2]) == sorted(first.values())


def test_near_copies_leave_one(stages):
    rows, _ = stages
    given = [(r["doc_id"], r["text"]) for r in rows[2]]
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(i for i, _, _, kept in near_brute(given, 5, 80) if kept)


def test_mixing_repeats_but_leaves_nothing_out(stages):
    rows, _ = stages
    times = Counter(r["doc_id"] for r in rows[4])
    assert set(times) == {r["doc_id"] for r in rows[3]} and max(times.values()) <= 2


def test_packing_places_every_row(stages):
    rows, _ = stages
    pieces = Counter((r["doc_id"], r["piece"]) for r in rows[5])
    times = Counter(r["doc_id"] for r in rows[4])
    assert {i: n for (i, piece), n in pieces.items() if piece == 0} == times
    used = Counter()
    for r in rows[5]:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 4096


def test_run(spark, data, stages):
    rows, _ = stages
    found = corpus_pipeline.run(spark, data)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r[k] for k in key) for r in found.collect()) == Counter(tuple(r[k] for k in key) for r in rows[5])
    assert corpus_pipeline.ORACLE_SQL is None
