import random
import zlib

import numpy as np
import pytest

from ledgerlens.llm import toxicity as T

DOCS = "doc_id bigint, text string, label int, votes string, toxic int"
LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=1500):
    rng, rows, labels = random.Random(2), [], []
    words = [f"{a}{b}" for a in ("mor", "lan", "tis", "ver", "ond") for b in ("a", "el", "im", "os", "uda", "ent")]
    for i in range(n):
        toxic = i % 6 == 0
        text = rng.choices(words, k=rng.randrange(20, 200))
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["zwurb" + rng.choice(words), "grokk", "Snafel"]))
        rows.append((i, " ".join(text), 1, "x", 0))
        if i % 2 or toxic:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def result(spark):
    rows, labels = corpus()
    odd = [(9000, None, 1, "x", 0), (9001, "", 1, "x", 0), (None, "mora grokk", 1, "x", 0), (12, rows[12][1], 1, "x", 0), (9002, "grokk " * 50_000, 1, "x", 0)]
    docs = spark.createDataFrame(rows + odd, DOCS)
    table = spark.createDataFrame(labels + [(None, 1, 1), (9001, 0, None), (3, None, 0)], LABELS)
    return rows + odd, T.score(docs, table, fit_rows=1000).collect(), docs, table


def test_every_row_is_scored(result):
    rows, found, *_ = result
    assert sorted((r["doc_id"] for r in found), key=repr) == sorted((r[0] for r in rows), key=repr)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and held_out(r["doc_id"]))
    assert next(r for r in found if r["doc_id"] == 9000)["score"] == next(r for r in found if r["doc_id"] == 9001)["score"] < 0.5


def test_held_out_rows_are_told_apart(result):
    found = [r for r in result[1] if r["held_out"] and r["doc_id"] < 1500]
    right = sum(r["predicted"] == (r["doc_id"] % 6 == 0) for r in found)
    assert len(found) > 200 and right >= 0.97 * len(found)
    caught = [r["predicted"] for r in found if r["doc_id"] % 6 == 0]
    assert sum(caught) >= 0.9 * len(caught)


def test_held_out_labels_teach_nothing(spark, result):
    _, found, docs, table = result
    flipped = [(i, q, 1 - t if t is not None and i is not None and held_out(i) else t) for i, q, t in map(tuple, table.collect())]
    again = T.score(docs, spark.createDataFrame(flipped, LABELS), fit_rows=1000)
    scores = lambda rows: sorted((repr(r["doc_id"]), round(r["score"], 9)) for r in rows)
    assert scores(again.collect()) == scores(found)


def test_label_model_finds_accuracies_and_correlations():
    rng, n = np.random.default_rng(5), 40_000
    y = rng.random(n) < 0.2
    hit, false = [0.8, 0.8, 0.6, 0.5], [0.05, 0.05, 0.1, 0.02]
    bits = [rng.random(n) < np.where(y, h, f) for h, f in zip(hit, false)]
    bits[1] = np.where(rng.random(n) < 0.8, bits[0], bits[1])  # voter 1 mostly repeats voter 0
    known = np.where(rng.random(n) < 0.1, y, -1)  # a tenth of the rows has labels
    cells, counts = np.unique(sum(b.astype(int) << i for i, b in enumerate(bits)) * 4 + known + 1, return_counts=True)
    model = T.LabelModel(4).fit(cells // 4, counts.astype(float), cells % 4 - 1)
    assert [0, 1] in model.blocks
    assert model.prior[1] == pytest.approx(0.2, abs=0.05)
    assert model.posterior(np.array([0]))[0] < 0.1 < 0.9 < model.posterior(np.array([0b1111]))[0]


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    docs = spark.createDataFrame([(1, "you are such an idiot and a moron", 1, "x", 0), (2, "a calm text", 1, "x", 0)], DOCS)
    assert T.score(docs, none).count() == 2
    empty = spark.createDataFrame([], DOCS)
    assert T.score(empty, none).count() == 0 and T.keep_clean(empty, none).columns == empty.columns


def test_only_the_toxic_rows_of_an_id_are_dropped(spark, monkeypatch):
    from pyspark.sql import functions as F

    from ledgerlens.llm import toxicity

    def judged(docs, labels, keep=()):
        return docs.select("doc_id", *keep, F.col("text").contains("vile").cast("int").alias("predicted"))

    monkeypatch.setattr(toxicity, "score", judged)
    rows = [(None, "vile one"), (None, "fine"), (None, None), (7, "vile"), (7, "good"), (7, "good"), (8, "vile")]
    kept = toxicity.keep_clean(spark.createDataFrame(rows, "doc_id bigint, text string"), None)
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([r for r in rows if "vile" not in (r[1] or "")], key=repr)
