import random
import re
from hashlib import sha256

import numpy as np
import pytest

from ledgerlens.llm.positional_index import contamination, item_words, near_matches, packed, phrase_matches, positional_index, unpacked

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, term string, segment int, n string"
ITEMS = "item_id bigint, text string, words string, term int"


def words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute(docs, items, length):
    out = []
    for doc_id, text, *_ in docs:
        own, hit, names = words(text), set(), set()
        for item_id, item, *_ in items:
            wanted = words(item)
            size = min(length, len(wanted))
            for at in range(len(wanted) - size + 1 if wanted else 0):
                for p in range(len(own) - size + 1):
                    if own[p : p + size] == wanted[at : at + size]:
                        hit.update(range(p, p + size))
                        names.add(item_id)
        names = sorted(str(n) for n in names if n is not None)
        out.append((doc_id, len(own), len(hit), len(names), sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def table(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["the", "a", "Ça", "été", "x1", "B", "zeta", "of", "日本", "rare"]
    text = lambda k, top=10: rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary[:top], k=k))
    items = [(i, text(rng.choice([0, 1, 3, 10, 11, 14, 30]), rng.choice([2, 5, 10])), "x", 1) for i in range(20)]
    items += [(3, text(12), None, None), (None, text(15), "y", 2), (21, None, "x", 1), (22, "", None, 0), (23, "nowhere else " * 6, None, 0)]
    docs = [(i, text(rng.choice([0, 1, 5, 40, 200]), rng.choice([2, 5, 10])), "x", 1, None) for i in range(n)]
    for i in range(0, n, 3):
        copied = words(rng.choice(items)[1])
        at = rng.randrange(max(1, len(copied) - 9))
        docs[i] = (i, text(5) + " - " + " ".join(copied[at : at + rng.choice([9, 10, 11, 40])]).upper() + " . " + text(3), "x", 1, "c")
    return docs + [docs[0], (5, "again the a", None, None, None), (None, docs[3][1], "z", 0, "z"), (77, None, None, None, None)], items


@pytest.mark.parametrize("length, block_words, segment_bytes", [(10, 200_000, 8_000_000), (10, 150, 500), (4, 200, 1)])
def test_equals_brute_force(spark, length, block_words, segment_bytes):
    docs, items = table()
    found = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), length, block_words=block_words, segment_bytes=segment_bytes)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(docs, items, length)


def test_a_document_of_one_repeated_word(spark):
    docs, items = [(1, "go " * 3000, None, None, None), (2, "go " * 9, None, None, None)], [(1, "go " * 25, None, None), (2, "go go", None, None)]
    found = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(docs, items, 10)


def test_stretches_are_whole_and_carry_their_place(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, f"before {item} after", None, None, None), (2, " ".join(item.split()[5:20]), None, None, None)]
    index = positional_index(spark.createDataFrame(docs, DOCS).coalesce(1))
    found = phrase_matches(index, item_words(spark.createDataFrame([(7, item, None, None)], ITEMS)))
    spans = sorted({(r["doc_no"], r["item_id"], r["start"], r["end"]) for r in found.collect()})
    covered = {(d, i): set().union(*(range(s, e) for dd, _, s, e in spans if dd == d)) for d, i, _, _ in spans}
    assert covered == {(0, 7): set(range(1, 31)), (1, 7): set(range(15))}


@pytest.mark.parametrize("within, block_words", [(0, 100), (5, 6)])
def test_proximity_equals_brute_force(spark, within, block_words):
    docs, _ = table(5)
    queries = [(1, "rare zeta"), (2, "the"), (3, "日本 x1 B"), (4, "rare rare Ça of"), (5, "missing the"), (6, None)]
    index = positional_index(spark.createDataFrame(docs, DOCS), segment_bytes=2000)
    asked = item_words(spark.createDataFrame([(*q, None, None) for q in queries], ITEMS))
    names = {(r["segment"], r["doc_no"]): r["doc_id"] for r in index.filter("term is null").collect()}
    got = sorted(((names[r["segment"], r["doc_no"]], r["item_id"], r["at"]) for r in near_matches(index, asked, within, block_words).collect()), key=repr)
    counts = {}
    for _, text, *_ in docs:
        for w in words(text):
            counts[w] = counts.get(w, 0) + 1
    want = []
    for doc_id, text, *_ in docs:
        own = words(text)
        for item_id, query in queries:
            terms = sorted(set(words(query)), key=lambda w: (counts.get(w, 0), w))
            for at, w in enumerate(own):
                if terms and w == terms[0] and all(t in own[max(0, at - within) : at + within + 1] for t in terms):
                    want.append((doc_id, item_id, at))
    assert got == sorted(want, key=repr)


def test_packed_numbers_come_back():
    numbers = np.array([0, 1, 127, 128, 300, 16383, 16384, 2**21, 2**28 - 1, 2**28, 2**31], np.int64)
    data, at = packed(numbers)
    assert unpacked(data).tolist() == numbers.tolist() and at[-1] == len(data)
    assert unpacked(packed(numbers[:0])[0]).tolist() == []


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert contamination(docs, spark.createDataFrame([(1, "a", None, None)], ITEMS)).count() == 0
    found = contamination(spark.createDataFrame([(1, "a b", None, None, None)], DOCS), items).collect()
    assert [tuple(r) for r in found] == [(1, 2, 0, 0, sha256(b"").hexdigest(), False)]
