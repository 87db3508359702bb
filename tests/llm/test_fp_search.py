import math
import random
import re

import numpy as np
import pytest

from ledgerlens.llm.fp_search import DocumentTree, ranked_search, scores

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, term string, ids int, n string"
ITEMS = "item_id bigint, text string, item_no string, score int"


def terms_of(text):
    return ["".join(c.lower() if c < "\x80" else c for c in w) for w in WORD.findall(text or "")]


def brute(docs, items, best):
    bags = [(i, terms_of(t)) for i, t, *_ in docs]
    full = [b for b in bags if b[1]]
    documents, length = len(full), sum(len(b) for _, b in full)
    df = {}
    for _, bag in full:
        for t in set(bag):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item_id, text, *_ in items:
        asked.setdefault(item_id, set()).update(terms_of(text))
    out = []
    for item_id, wanted in asked.items():
        rows = []
        for doc_id, bag in full:
            m = 100 - 50 + (50 * len(bag) * documents) // length
            score = 0
            for t in wanted & set(bag):
                tf, w = bag.count(t), math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                rows.append((-score, doc_id is not None, doc_id))
        out += [(item_id, k + 1, doc_id, -s) for k, (s, _, doc_id) in enumerate(sorted(rows)[:best])]
    return sorted(out, key=repr)


def table(n=300, seed=2):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "Été", "x1", "B_c"] + [f"w{i}" for i in range(60)]
    weights = [50, 40, 20, 20, 10] + [10 / (i + 1) for i in range(60)]
    text = lambda k: rng.choice([" ", ", ", "\n", "-"]).join(rng.choices(vocabulary, weights, k=k))
    docs = [(i, text(rng.choice([0, 1, 4, 30, 200])), "t", 1, None) for i in range(n)]
    docs += [(n + i, docs[8][1], None, None, "n") for i in range(90)]  # copies, which tie
    docs += [docs[4], (None, docs[3][1], "a", 0, "b"), (999, None, None, None, None), (998, "word " * 5000, None, None, None)]
    items = [(i, text(rng.choice([0, 1, 3, 20])), "x", 1) for i in range(12)]
    items += [(2, text(5), None, None), (None, text(6), "y", 2), (50, None, None, None), (51, "nowhere", None, None), (52, docs[8][1], None, None)]
    return docs, items


@pytest.mark.parametrize("best, block_terms, tree_docs", [(50, 8192, 2048), (7, 30, 40), (1000, 8192, 1)])
def test_equals_brute_force(spark, best, block_terms, tree_docs):
    docs, items = table(300 if tree_docs > 1 else 60)
    found = ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), best, block_terms=block_terms, tree_docs=tree_docs)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(docs, items, best)


def tree_of(n=400, width=30, seed=4):
    rng = np.random.default_rng(seed)
    rows = [np.flatnonzero(rng.random(width) < 1 / np.arange(1, width + 1) ** 0.5) for _ in range(n)]
    at = np.r_[0, np.cumsum([len(r) for r in rows])]
    tf = rng.integers(1, 5, at[-1])
    return DocumentTree(at, np.concatenate(rows), tf, rng.integers(50, 150, n), width)


def test_nodes_bound_all_documents_below_them():
    tree = tree_of()
    for node in range(len(tree.low)):
        low, high = tree.low[node], tree.high[node]
        assert (tree.most[node] == tree.tf[low:high].max(axis=0)).all() and tree.least[node] == tree.m[low:high].min()
        if tree.children[node]:
            parts = sorted((tree.low[c], tree.high[c]) for c in tree.children[node])
            assert parts[0][0] == low and parts[-1][1] == high and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


def test_subtrees_below_the_bound_are_left_out(monkeypatch):
    tree, seen = tree_of(), []
    terms, weights = np.array([20, 25, 28]), np.array([900, 1000, 1100])
    every = scores(tree.tf[:, terms], tree.m, weights)
    monkeypatch.setattr("ledgerlens.llm.fp_search.scores", lambda tf, m, w: (seen.append(len(m)), scores(tf, m, w))[1])
    found, values = tree.best(terms, weights, np.zeros(0, np.int64), 5)
    assert sorted(values.tolist())[-5:] == sorted(every.tolist())[-5:]
    assert sum(seen[1:]) < len(every)  # without the bounds of the nodes, fewer than all documents were scored


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert ranked_search(docs, spark.createDataFrame([(1, "a", None, None)], ITEMS)).count() == 0
    assert ranked_search(spark.createDataFrame([(1, "a b", None, None, None)], DOCS), items).count() == 0
