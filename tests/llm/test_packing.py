import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm.packing import fit_vectors, pack, pack_documents, pieces

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, piece string, length int"
TEXTS = [
    None, "", " \n\t", "Don't STOP, it's 42 naïve cafés and more\x1cthings", "éte ́x", "İstanbul ΣΑΣ ΑΣ", "a<|endoftext|>b <|startoftext|>", "A<|ENDOFTEXT|>. (b)., it's. 3.,; é.! ...",
    "word " * 5000, "x" * 30000, "日本語のテキスト。" * 900, "\U0001f600\U0001f600 !!??", "same", "same",
    "dogs' it's' 'tis é's é' ×. ÷, ÿ$$$ À-- a_ _ a__b 9'9 9.' x'. ¿qué? naïve.» ».. é<| |", "..", "'s", "don't'", "a.", ".b c", "ſ's ß&&& ñ***", "e\u0301. e\u0301\u0301, a\u200d! \u00a0. a\u00a0, b\u3000;", "=\u0338 a=\u0338 <\u0338",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(3, "again", None, None), (None, "no id", "y", 2)]
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("options", [{}, {"rule": "dot"}, {"most_documents": 2}, {"part_rows": 4}])
def test_every_id_has_its_place(docs, options):
    df, rows = docs
    found = pack_documents(df, FILE, **options).toPandas()
    tokenizer, want = Tokenizer.from_file(FILE), []
    for i, t, *_ in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((-1 if i is None else i, k, at, len(part), zlib.crc32(part.tobytes())))
    got = found.fillna({"doc_id": -1}).astype("int64")
    assert sorted(map(tuple, got[["doc_id", "piece", "start", "length", "ids_crc32"]].values.tolist())) == sorted(want)
    for _, one in found.sort_values("offset").groupby("sequence_id"):
        assert one["length"].sum() <= 4096 and len(one) <= options.get("most_documents", 4096)
        assert one["offset"].tolist() == [0, *one["length"].cumsum().tolist()[:-1]]


def test_best_fit_takes_the_fullest_sequence_and_meets_every_limit():
    where, offset = fit_vectors(np.array([6, 5, 4, 3, 2]), (10, 10, 100), (1, 0, 0), "norm")
    assert where.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]
    where, _ = fit_vectors(np.array([6, 5, 4, 3, 2]), (10, 10, 40), (1, 0, 0), "norm")
    assert where.tolist() == [0, 1, 2, 1, 1]


def test_few_sequences(spark):
    lengths = np.random.default_rng(3).integers(1, 3000, 4000)
    where, _ = fit_vectors(np.sort(lengths)[::-1], (4096, 4096, 4096**2), (1, 0.05, 0.05), "norm")
    assert where.max() + 1 <= 1.01 * lengths.sum() / 4096 + 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pieces(empty, FILE).count() == 0 and pack_documents(empty, FILE).count() == 0


def test_many_pieces_with_one_key_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr("ledgerlens.llm.packing.MOST_AT_ONCE", 50)
    cut = spark.createDataFrame([(1, 0, 0, 9, 5)] * 300, "doc_id bigint, piece bigint, start bigint, length bigint, ids_crc32 bigint")
    found = pack(cut, capacity=20).toPandas()
    assert len(found) == 300 and found.groupby("sequence_id")["length"].sum().max() <= 20
