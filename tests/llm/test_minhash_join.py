import random
import re

import numpy as np
import pytest

from ledgerlens.llm import minhash_join as M

SCHEMA = "doc_id bigint, text string, pair string, root int"


def brute(rows, words, percent):
    """Components by comparing all pairs of sets of word tuples."""
    sets, top = [], {}
    for i, (doc_id, text, *_) in enumerate(rows):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
        top[i] = i

    def root(i):
        return i if top[i] == i else root(top[i])

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]) and None not in (rows[i][0], rows[j][0]):
                top[root(i)] = root(j)
    least = {}
    for i, row in enumerate(rows):
        least[root(i)] = min(x for x in (least.get(root(i)), row[0]) if x is not None) if row[0] is not None else None
    return sorted(((r[0], len(sets[i]), least[root(i)], least[root(i)] == r[0]) for i, r in enumerate(rows)), key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(n):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 4, 30, 120]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 15)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((rng.choice([" ", "\n", "  "])).join(copy))
    rng.shuffle(rows)
    odd = [(None, "no id at all here", "x", 1), (None, None, None, None), (7000, None, "y", 2), (7001, "", "y", 2), (7002, " \n", "y", 2), (3, rows[3], "x", 1)]
    return [(i, t, "x", 1) for i, t in enumerate(rows)] + odd


@pytest.mark.parametrize("words,percent,block", [(3, 85, 512), (5, 80, 4)])
def test_equals_brute_force(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(M, "BLOCK_ROWS", block)
    rows = corpus(60, 5)
    found = M.near_duplicates(spark.createDataFrame(rows, SCHEMA), words, percent)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows, words, percent)


def test_shingles_never_cross_texts():
    texts = [b"a b c d", b"", b"  c d a", b"A\tB\nC  d", b"x", b"c d"]
    raw, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    hashes, ends = M.shingles(raw, at, 3)
    sets = [set(hashes[ends[i] : ends[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [2, 0, 1, 2, 1, 1] and sets[0] == sets[3] and len(set.union(*sets)) == 5


def test_all_pairs_within_the_distance_share_an_entry(spark):
    rng, most = np.random.default_rng(1), M.distance(96, 85)
    rows = []
    for i in range(100):
        a = rng.integers(0, 65536, 96).astype(np.uint16)
        b = a.copy()
        b[rng.choice(96, most, replace=False)] ^= 1
        rows += [(2 * i, bytearray(a.tobytes())), (2 * i + 1, bytearray(b.tobytes()))]
    found = M.entries(spark.createDataFrame(rows, "class_id bigint, signature binary"), 96, 85).toPandas()
    for i in range(100):
        one, two = (set(found.entry[found.class_id == c]) for c in (2 * i, 2 * i + 1))
        assert one & two


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert M.near_duplicates(empty).count() == 0 and M.keep_one(empty).columns == empty.columns


def test_rows_of_one_id_are_told_apart_by_their_text(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(f"w{rng.randrange(1000)}" for _ in range(60)) for _ in range(3))
    rows = [(5, a, "", 0), (5, b, "", 0), (5, c, "", 0), (3, a + " end", "", 0), (8, b + " end", "", 0), (9, c + " end", "", 0), (None, a, "", 0), (None, b, "", 0)]
    found = M.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows, 5, 80)
    kept = {(r["doc_id"], r["text"]) for r in M.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == {(5, b), (5, c), (3, a + " end"), (None, a), (None, b)}
