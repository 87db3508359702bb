import random
import zlib
from hashlib import sha256

import pytest

from ledgerlens.llm import prefix_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, name int, size bigint"


def brute(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == len(prefix)))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(convs), len(prefix), parent, len(convs), len(children), len(leaves), saved, sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(n=60, deepest=9, seed=3):
    rng = random.Random(seed)
    openings = [[(rng.choice(["user", "assistant", None]), rng.choice(["hi", "Çava", "", None, "x" * 40, "\U0001f600"])) for _ in range(40)] for _ in range(3)]
    rows = []
    for c in rng.sample([*range(0, 320), *range(500, 560)], n) + [0, 100, 1000]:
        own = rng.choice(openings)[: rng.randrange(1, deepest)]
        own = own + [("user", rng.choice(["a", "b"])) for _ in range(rng.randrange(3))]
        rows += [(c, t, r, x, "z", 1, None) for t, (r, x) in enumerate(own)]
    rows += [rows[0], (7, None, "user", "no turn", None, None, None), (7, None, None, None, None, None, None), (None, 1, "user", "no id", None, None, None)]
    rows += [(31, 4, "user", "tie one", None, 0, 0), (31, 4, "user", "tie two", None, 0, 0)]
    return rows


@pytest.mark.parametrize("n, deepest", [(60, 9), (12, 40)])
def test_equals_brute_force(spark, n, deepest, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    rows = table(n, deepest)
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)


def test_conversations_without_turns_end_at_the_root(spark):
    # 103 takes its first turns from 100, which is not there, and has none beyond them.
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    rows = [(c, 1, "user", "only", None, None, None)]
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(c, 0, None, 1, 0, 1, 0, sha256(str(c).encode()).hexdigest())] == brute(rows)


def test_empty_table(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
