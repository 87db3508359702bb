import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from ledgerlens.llm import substring_dedup as S

SCHEMA = "doc_id bigint, text string, key string, spans int"


def brute(rows, length):
    raw = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (doc_id, *_), b in zip(rows, raw):
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i + 1 : i + length + 1] = True
        edges = np.flatnonzero(np.diff(gone.astype(int)))
        kept = bytes(c for c, g in zip(b, gone[1:]) if not g)
        out.append((doc_id, len(b), int(gone.sum()), len(edges) // 2, sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)

    def text(n):
        return "".join(rng.choices("abcdefgh iü", k=n))

    shared = [text(n) for n in (19, 20, 21, 35, 60, 200)]
    texts = [text(rng.randrange(0, 120)) for _ in range(40)]
    for _ in range(80):
        base = "".join(rng.choice([text(rng.randrange(0, 40)), rng.choice(shared)]) for _ in range(rng.randrange(1, 6)))
        texts.append(base)
        edited = list(base)
        if edited:
            edited[rng.randrange(len(edited))] = "Z"
            texts.append("".join(edited))
    texts += ["a" * 70, "ab" * 50, "aab" * 40, "x" * 20, "x" * 19, "y" * 20, "", "same row " * 5, "\x00" * 50, "q\x00" * 30]
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)]
    return rows + [(None, None, None, None), (None, text(50), "k", 1), rows[-3], (7, text(60) + shared[-1], "k", 1)]


@pytest.mark.parametrize("group,segment", [(20_000, 2_000_000), (1, 2_000_000), (20_000, 64)])
def test_equals_brute_force(spark, monkeypatch, group, segment):
    monkeypatch.setattr(S, "GROUP_CONTEXTS", group)
    monkeypatch.setattr(S, "SEGMENT", segment)
    rows = corpus(3)
    found = S.removed(spark.createDataFrame(rows, SCHEMA), length=20, gram=8)
    assert sorted((tuple(r)[:5] for r in found.collect()), key=repr) == brute(rows, 20)


def test_test_table_at_full_length(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    found = S.removed(docs).collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == brute(rows, 400)


def test_induction_equals_comparing_windows():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n, length = 40, 12
        group = np.sort(rng.integers(0, 4, n))
        last = rng.integers(0, 9, n)
        first = np.maximum(0, last - rng.integers(0, 9, n))
        data = [bytes(rng.integers(0, 2, int(b) + length - int(a), dtype=np.uint8)) for a, b in zip(first, last)]
        seen = Counter((g, d, x[b - d : b - d + length]) for g, a, b, x in zip(group, first, last, data) for d in range(a, b + 1))
        want = [(r, d) for r in range(n) for d in range(first[r], last[r] + 1) if seen[group[r], d, data[r][last[r] - d : last[r] - d + length]] > 1]
        assert sorted(S.induced(group, first, last, data, length)) == sorted(want)


def test_empty_table(spark):
    assert S.removed(spark.createDataFrame([], SCHEMA)).count() == 0
