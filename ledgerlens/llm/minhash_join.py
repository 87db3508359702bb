"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures (operator 6, Arrow tasks and joins).

A document is the set of its distinct word shingles, a signature ``symbols`` minima of 16 bits each. Two sets of the asked
similarity differ in more than ``distance`` symbols with a probability below ``miss``. By the pigeonhole principle two
signatures within that distance have a chunk with at most ``errors`` errors, if there are more than
distance / (errors + 1) chunks; every chunk is therefore entered once for each choice of ``errors`` symbols that are left
out, and all pairs within the distance share an entry.

Documents with equal sets are one class. Entries tie each class to the smallest one of the entry, so that an entry of n
classes makes n rows and not n^2; the connected parts of these ties hold every pair within the distance. Parts are cut
into blocks of bounded size, block pairs are compared in tasks, first by signature and then on the full sets, and pairs
that are connected already are passed over. A task returns at most one link for each of its documents.

Cases: blanks alone, empty and null texts have an empty set and are linked with nothing. With fewer words than a shingle
the whole sequence is the only element. Rows that repeat a doc_id are linked by their own text, and equal ones get equal rows. A row with a null doc_id is linked with
nothing and stays. An empty table gives no rows. Further columns are not read, whatever their names.
"""

from __future__ import annotations

from hashlib import blake2b
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ledgerlens.llm.arrays import mixed, numbers, text_blocks
from ledgerlens.llm.exact_dedup import free_name
from ledgerlens.llm.graphs import components
from ledgerlens.session import stage

SYMBOLS, ERRORS, MISS = 96, 1, 1e-6
BLOCK_ROWS, BLOCK_SHINGLES = 512, 200_000


def distance(symbols: int, percent: int, miss: float = MISS) -> int:
    """The least number of differing symbols that pairs of the asked similarity exceed with at most probability ``miss``."""
    q, tail, most = 1 - percent / 100, 1.0, -1
    while tail > miss:
        most += 1
        tail -= comb(symbols, most) * q**most * (1 - q) ** (symbols - most)
    return most


def chunks(symbols: int, percent: int, errors: int = ERRORS) -> list[list[int]]:
    """Symbols of each chunk; there are enough chunks for the pigeonhole principle."""
    return [list(map(int, c)) for c in np.array_split(np.arange(symbols), distance(symbols, percent) // (errors + 1) + 1)]


def shingles(raw: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all word shingles of the texts, and where those of each text begin and the last end."""
    n, texts = len(raw), len(at) - 1
    none = np.zeros(0, np.uint64), np.zeros(texts + 1, np.int64)
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    value = numbers(256, 11)[low]
    value[[9, 10, 11, 12, 13, 32]] = 0
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    before = np.ones(n, bool)
    before[1:] = blank[:-1]
    before[at[:-1][at[:-1] < n]] = True  # matches never cross texts
    start = np.flatnonzero(before & ~blank)
    if not len(start):
        return none
    # A word is the sum of its bytes' numbers times powers of an odd number; blanks and the next text's blanks add nothing.
    length = np.diff(np.append(start, n))
    power = np.cumprod(np.full(int(length.max()), 0x9E3779B97F4A7C13, np.uint64))
    place = np.arange(start[0], n) - np.repeat(start, length)
    word = mixed(np.add.reduceat(value[raw[start[0] :]] * power[place], start - start[0]))
    first = np.searchsorted(start, at)  # first word of each text
    count = np.diff(first)
    factor = numbers(words, 12)
    full = np.maximum(count - words + 1, 0)
    row = np.repeat(np.arange(texts), full)
    begin = np.cumsum(full) - full
    head = first[:-1][row] + np.arange(len(row)) - begin[row]
    total = np.zeros(len(row), np.uint64)
    for i in range(words):
        total += word[head + i] * factor[i]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):  # the whole sequence, with its length
        extra = count[short].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        for i in range(words - 1):
            has = count[short] > i
            extra[has] += word[first[:-1][short[has]] + i] * factor[i]
        row = np.concatenate([row, short])
        total = np.concatenate([total, extra])
        order = np.argsort(row, kind="stable")
        row, total = row[order], total[order]
    return mixed(total), np.searchsorted(row, np.arange(texts + 1))


def signatures(hashes: np.ndarray, at: np.ndarray, symbols: int) -> np.ndarray:
    """16-bit symbols of each set; rows of empty sets are zero."""
    out = np.zeros((len(at) - 1, symbols), np.uint16)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        for j, (flip, times) in enumerate(zip(numbers(symbols, 21), numbers(symbols, 22) | np.uint64(1))):
            out[some, j] = mixed(np.minimum.reduceat((hashes ^ flip) * times, at[some])) >> np.uint64(48)
    return out


def sets(docs: DataFrame, words: int, symbols: int, whole: bool) -> DataFrame:
    """The rows of ``docs`` (text last) with n_shingles, set_key (128 bits, null when empty), signature and, if ``whole``,
    the sorted set itself instead of the text."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    more = [StructField("n_shingles", LongType()), StructField("set_key", BinaryType()), StructField("signature", BinaryType())]
    more += [StructField("elements", BinaryType())] * whole
    schema = StructType(kept + more)

    def work(batches):
        for batch in batches:
            for first, last, raw, at in text_blocks(batch.column(len(kept))):
                hashes, ends = shingles(raw, at, words)
                signature = signatures(hashes, ends, symbols)
                size, key, own = [], [], []
                for i in range(last - first):
                    s = np.sort(hashes[ends[i] : ends[i + 1]])
                    if len(s):
                        s = s[np.concatenate([[True], s[1:] != s[:-1]])]
                    size.append(len(s))
                    key.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    if whole:
                        own.append(s.tobytes())
                columns = [pa.array(size, pa.int64()), pa.array(key, pa.binary()), pa.array([r.tobytes() for r in signature], pa.binary())]
                columns += [pa.array(own, pa.binary())] * whole
                rows = [batch.column(i).slice(first, last - first) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(rows + columns, schema.names)

    return docs.mapInArrow(work, schema)


def entries(classes: DataFrame, symbols: int, percent: int, errors: int = ERRORS) -> DataFrame:
    """(entry, class_id): the index entries of every class."""
    parts = chunks(symbols, percent, errors)

    def enter(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            value = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(ids), symbols).astype(np.uint64)
            value = mixed(value + numbers(symbols, 31)[None, :])
            salt, out = iter(numbers(4096 * len(parts), 32)), []
            for part in parts:
                for left_out in combinations(part, min(errors, len(part))):
                    seen = [p for p in part if p not in left_out]
                    out.append(mixed(value[:, seen].sum(axis=1, dtype=np.uint64) + next(salt)).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(np.tile(ids, len(out)))], ["entry", "class_id"])

    return classes.select("class_id", "signature").mapInArrow(enter, "entry bigint, class_id bigint")


def compared(pairs: DataFrame, symbols: int, percent: int) -> DataFrame:
    """Links (a, b) of the block pairs, enough of them to connect all that is linked within a block pair.

    Rows: pair (text of part and both blocks), side, class_id, signature, elements; a pair's rows stand together.
    """
    most = distance(symbols, percent)

    def links(rows):
        ids = np.array([r[2] for r in rows])
        side = np.array([r[1] for r in rows])
        signature = np.frombuffer(b"".join(r[3] for r in rows), np.uint16).reshape(len(rows), symbols)
        own = [np.frombuffer(r[4], np.uint64) for r in rows]
        size = np.array([len(s) for s in own])
        top = list(range(len(rows)))

        def root(i):
            while top[i] != i:
                top[i] = top[top[i]]
                i = top[i]
            return i

        cross, near = side.max() > 0, []
        for i in range(len(rows)):
            if cross and side[i] == 1:
                continue
            other = np.flatnonzero(side == 1) if cross else np.arange(i + 1, len(rows))
            fits = (np.minimum(size[other], size[i]) * 100 >= percent * np.maximum(size[other], size[i]))
            other = other[fits]
            apart = (signature[other] != signature[i]).sum(axis=1)
            near += [(int(d), i, int(j)) for d, j in zip(apart[apart <= most], other[apart <= most])]
        for _, i, j in sorted(near):
            if root(i) == root(j):
                continue
            small, large = (own[i], own[j]) if size[i] < size[j] else (own[j], own[i])
            where = np.minimum(np.searchsorted(large, small), len(large) - 1)
            common = int((large[where] == small).sum())
            if 100 * common >= percent * (len(small) + len(large) - common):
                top[root(i)] = root(j)
                yield int(ids[i]), int(ids[j])

    def work(batches):
        held, name = [], None
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != name:
                    found += links(held) if len(held) > 1 else []
                    held, name = [], row[0]
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])
        found = list(links(held)) if len(held) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return pairs.mapInArrow(work, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, symbols: int = SYMBOLS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents with 100 * intersection >= percent * union are linked."""
    return rows_of_components(docs, words, percent, symbols).drop("text_sha256")


def text_digest():
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)


def rows_of_components(docs: DataFrame, words: int, percent: int, symbols: int) -> DataFrame:
    """As ``near_duplicates``, with text_sha256, which tells rows of one doc_id apart."""
    text = F.col("text").cast("string").alias("text")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_digest().alias("text_sha256"), text)
    signed = stage(sets(docs, words, symbols, whole=False), "signed")
    classes = signed.filter("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_sha256")).alias("first"), F.min("signature").alias("signature"), F.min("n_shingles").alias("n_shingles")
    )
    # One doc_id may be the smallest of several sets, so classes have numbers of their own, fixed by the written table.
    classes = stage(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    index = entries(classes, symbols, percent)
    shared = index.groupBy("entry").agg(F.min("class_id").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stage(shared.select("entry", "centre"), "shared-entries")  # a plain table: Spark can split a hot entry in the join
    ties = index.join(shared, "entry").select(F.col("class_id").alias("a"), F.col("centre").alias("b"))
    part = components(ties)
    links = linked(docs, classes, part, words, percent, symbols)
    joined = components(links)
    first = classes.select(F.col("class_id").alias("node"), F.col("first.doc_id").alias("first_id"))
    smallest = joined.join(first, "node").groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = joined.join(smallest, "root").select(F.col("node").alias("class_id"), "component_id")
    named = signed.join(classes.select("set_key", "class_id", F.col("first.doc_id").alias("first_id")), "set_key", "left").join(component, "class_id", "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "first_id", "doc_id"))
    return named.select("doc_id", "text_sha256", "n_shingles", found.alias("component_id"), found.eqNullSafe(F.col("doc_id")).alias("kept"))


def linked(docs: DataFrame, classes: DataFrame, part: DataFrame, words: int, percent: int, symbols: int) -> DataFrame:
    """Links within the parts, confirmed on full sets. Only documents that stand for a class of a part are read again."""
    size = part.join(classes, part["node"] == classes["class_id"]).groupBy("root").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    members = part.join(size, "root").join(classes.select(F.col("class_id").alias("node"), "set_key", "first"), "node")
    members = members.withColumnsRenamed({"node": "class_id", "set_key": "class_key"})
    own = (docs["doc_id"] == members["first.doc_id"]) & (docs["text_sha256"] == members["first.text_sha256"])
    chosen = docs.join(members, own).select("class_id", "root", "blocks", "class_key", "text")
    whole = sets(chosen, words, symbols, whole=True).filter("set_key = class_key").dropDuplicates(["class_id"])
    block = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    spread = whole.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    pairs = spread.select(
        F.concat_ws(":", "root", low, high).alias("pair"),
        F.when(low == high, 0).otherwise((F.col("block") == high).cast("int")).alias("side"),
        "class_id", "signature", "elements",
    )
    return stage(compared(pairs.repartition("pair").sortWithinPartitions("pair", "class_id"), symbols, percent), "links")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Whole rows of ``docs``, of each group of near duplicates the document with the smallest id."""
    found = rows_of_components(docs, words, percent, SYMBOLS).filter("NOT kept")
    dropped = found.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    name = free_name(docs, "_text_sha256")
    marked = docs.withColumn(name, text_digest())
    same = (marked["doc_id"].cast("bigint") == dropped["_id"]) & (marked[name] == dropped["_sha"])
    return marked.join(dropped, same, "left_anti").drop(name)
