import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlens.llm.sharding import admitted, even, filled, shards_of

SCHEMA = "doc_id bigint, text string, shard string, size string, n int"


def rows(seed, hot):
    rng, texts = random.Random(seed), []
    texts += ["the hot text"] * hot
    for i in range(40):
        texts += [f"group {i} ünï"] * rng.randrange(2, 5)
    texts += [f"single {i} " * rng.randrange(1, 50) for i in range(150)] + [None, None, "", "\x00"]
    rng.shuffle(texts)
    return [(i, t, "x", "y", 1) for i, t in enumerate(texts)] + [(None, "no id", "x", "y", 1), (3, texts[3], "x", "y", 1)]


@pytest.mark.parametrize("hot", [2, 150])
def test_law_slots_and_links(spark, hot):
    given = rows(4, hot)
    found = shards_of(spark.createDataFrame(given, SCHEMA), shards=8).collect()
    raw = [(i, (t or "").encode()) for i, t, *_ in given]
    want = sorted(((i, len(b) + 16, zlib.crc32(b)) for i, b in raw), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == want
    count = Counter(r["shard"] for r in found)
    assert set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    places = defaultdict(set)
    for r in found:
        places[r["text_crc32"]].add(r["shard"])
    split = sum(len(places[zlib.crc32(f"group {i} ünï".encode())]) > 1 for i in range(40))
    assert split <= 4  # dealt at random, nearly all of them would be


def test_no_shard_exceeds_its_quota():
    rng = np.random.default_rng(2)
    for _ in range(50):
        load = rng.integers(0, 20, 6)
        quota = load + rng.integers(0, 5, 6)
        wishes = [(a, b, c, n) for a in range(6) for b in range(6) for c in range(2) if a != b and (n := min(int(rng.integers(0, 4)), load[a] // 12))]
        cells = np.array(wishes, np.int64).reshape(-1, 4)
        kept = cells[admitted(cells, load, quota)]
        after = load + np.bincount(kept[:, 1], kept[:, 3], 6) - np.bincount(kept[:, 0], kept[:, 3], 6)
        assert (after <= quota).all()


@pytest.mark.parametrize("given", [[], [(1, "a", "x", "y", 1)], [(i, "same", "x", "y", 1) for i in range(50)]])
def test_few_rows(spark, given):
    found = shards_of(spark.createDataFrame(given, SCHEMA), shards=8).collect()
    count = Counter(r["shard"] for r in found)
    assert len(found) == len(given) and (not given or max(count.values()) - min([count.get(s, 0) for s in range(8)]) <= 1)


def test_a_hot_group_spans_no_more_shards_than_it_must(spark):
    """Two groups larger than a shard, beside small groups and single rows."""
    sizes = {"hot": 400, "warm": 130, "even": 55}
    given = [t for t, n in sizes.items() for _ in range(n)] + [f"pair {i // 2}" for i in range(200)] + [f"single {i}" for i in range(415)]
    random.Random(1).shuffle(given)
    rows = [(None if t == "hot" and i % 3 == 0 else i, t, "x", "y", 1) for i, t in enumerate(given)]
    found = shards_of(spark.createDataFrame(rows, SCHEMA), shards=40).collect()
    count = Counter(r["shard"] for r in found)
    assert len(found) == 1200 and set(count.values()) == {30}
    for text, n in sizes.items():
        spanned = {r["shard"] for r in found if r["text_crc32"] == zlib.crc32(text.encode())}
        assert len(spanned) == -(-n // 30)


def test_filled_and_even_keep_within_the_room():
    rng = random.Random(3)
    for _ in range(200):
        n, shards = rng.randrange(1, 400), rng.randrange(1, 12)
        quota = np.array([n // shards + (s < n % shards) for s in range(shards)])
        sizes, rest = [], n
        while rest > quota.max():
            sizes.append(rng.randrange(quota.max() + 1, rest + 1))
            rest -= sizes[-1]
        room = quota.copy()
        for own, size in zip(filled(sizes, quota), sizes):
            assert sum(k for _, k in own) == size and all(k > 0 for _, k in own)
            for s, k in own:
                room[s] -= k
        assert (room >= 0).all() and room.sum() == rest
        dealt = even(rest, room)
        assert dealt.sum() == rest and (dealt <= room).all() and (dealt >= 0).all()
