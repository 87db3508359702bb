"""Ranked lexical search over trees of documents (operator 11, Arrow tasks).

One pass over the texts keeps of each document the number of its terms and its term vector restricted to the terms that items
ask for. The vectors are written, and everything the score needs of the corpus (documents, length, document frequencies) is
summed from them.

A second pass builds, for every ``TREE_DOCS`` documents, a frequent-pattern tree: the terms of a vector are ordered by falling
document frequency, so that documents share the path of their frequent terms. A node is the documents below one path; it holds
the largest tf of every term and the smallest m below it. For each item the tree is walked depth first, the child with the
higher bound first: the score with those tf and that m is an upper bound for the subtree, which is left out once the bound is
below the item's worst kept score. Leaves of a few documents are scored exactly. The kept scores of an item stay from tree to
tree of a task, and the best of all tasks are ranked in the end.

Items are asked in blocks of at most about ``BLOCK_TERMS`` terms, so what a task gets, and the width of a tree's tables, is
bounded however many items there are; each block is a pass over the texts.

Cases: terms are runs of digits, letters and characters beyond ASCII, with A to Z lowered. A null or empty text has none and is
never found; an item without terms finds nothing. Rows that share an item_id, null included, are one item with the terms of all.
Rows that repeat a doc_id are documents of their own, each with a rank. Among equal scores a null doc_id comes first. Empty
tables give no rows. Only the columns named by the arguments are read, whatever the names of others.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ledgerlens.llm.words import word_blocks
from ledgerlens.session import stage

BEST = 50
BLOCK_TERMS = 8192
TREE_DOCS = 2048
LEAF_DOCS = 16
# Constants of the score.
SCALE, TF_WEIGHT, M_WEIGHT, LENGTH_SHARE = 1_000_000_000, 1000, 20, 50


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term): the distinct terms of every item."""
    own = items.schema[item_id].dataType
    schema = StructType([StructField("item_id", own)]).add("term", "string")

    def split(batches):
        for batch in batches:
            for block in word_blocks(batch.column(1)):
                row = np.searchsorted(block.at, np.arange(len(block.codes)), "right") - 1
                pairs = np.unique(row << 32 | block.codes)
                terms = block.distinct.cast(pa.large_string()).cast(pa.string()).take(pa.array(pairs & 0xFFFFFFFF))
                ids = batch.column(0).take(pa.array((pairs >> 32) + block.first))
                yield pa.RecordBatch.from_arrays([ids, terms], names=["item_id", "term"])

    texts = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    return texts.mapInArrow(split, schema).distinct()


def restricted_vectors(docs: DataFrame, terms: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, ids, tfs): all terms of each document counted, and the numbers and frequencies of those in ``terms``."""
    kinds = [("doc_id", docs.schema[doc_id].dataType), ("n", LongType()), ("ids", ArrayType(IntegerType())), ("tfs", ArrayType(IntegerType()))]
    schema = StructType([StructField(n, t) for n, t in kinds])
    asked = pa.array([t.encode() for t in terms], pa.large_binary())

    def restrict(batches):
        import pyarrow.compute as pc

        for batch in batches:
            for block in word_blocks(batch.column(1)):
                rows = block.last - block.first
                number = np.asarray(pc.index_in(block.distinct, value_set=asked).fill_null(-1))
                own = number[block.codes]
                at = np.flatnonzero(own >= 0)
                row = np.searchsorted(block.at, at, "right") - 1
                pairs, tf = np.unique(row << 32 | own[at], return_counts=True)
                ends = np.searchsorted(pairs, np.arange(rows + 1, dtype=np.int64) << 32).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, rows),
                        pa.array(np.diff(block.at)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array((pairs & 0xFFFFFFFF).astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int32))),
                    ],
                    names=schema.names,
                )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(restrict, schema)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class DocumentTree:
    """Frequent-pattern tree of some documents whose vectors hold the terms as ranks of falling document frequency."""

    def __init__(self, at: np.ndarray, ranks: np.ndarray, tf: np.ndarray, m: np.ndarray, width: int, leaf: int = LEAF_DOCS):
        self.leaf = leaf
        paths = [ranks[a:b].astype(">u4").tobytes() for a, b in zip(at[:-1], at[1:])]
        self.order = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
        self.paths = [np.frombuffer(paths[i], ">u4") for i in self.order]
        self.m = m[self.order]
        place = np.empty(len(paths), np.int64)
        place[self.order] = np.arange(len(paths))
        self.tf = np.zeros((len(paths), width), np.int32)
        self.tf[np.repeat(place, np.diff(at)), ranks] = tf
        self.low: list[int] = []
        self.high: list[int] = []
        self.children: list[list[int]] = []
        self.grow(0, len(paths))
        low = np.array(self.low)
        leaves = np.flatnonzero([not c for c in self.children])
        leaves = leaves[np.argsort(low[leaves])]
        self.most = np.zeros((len(low), width), np.int32)
        self.least = np.zeros(len(low), np.int64)
        self.most[leaves] = np.maximum.reduceat(self.tf, low[leaves], axis=0)
        self.least[leaves] = np.minimum.reduceat(self.m, low[leaves])
        for node in reversed(range(len(low))):  # children come after their parent
            if self.children[node]:
                self.most[node] = self.most[self.children[node]].max(axis=0)
                self.least[node] = self.least[self.children[node]].min()

    def grow(self, low: int, high: int) -> int:
        """Add the tree of the documents ``low`` to ``high`` in path order; a path without branches is one node."""
        root = len(self.low)
        waiting = [(low, high, None)]
        while waiting:
            low, high, parent = waiting.pop()
            node = len(self.low)
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            if parent is not None:
                self.children[parent].append(node)
            first, last = self.paths[low], self.paths[high - 1]
            shared = min(len(first), len(last))
            differ = np.flatnonzero(first[:shared] != last[:shared])
            depth = int(differ[0]) if len(differ) else shared
            if high - low <= self.leaf or depth == len(last):  # few documents, or all the same
                continue
            branch = np.array([int(p[depth]) if len(p) > depth else -1 for p in self.paths[low:high]])
            cuts = low + np.r_[0, np.flatnonzero(np.diff(branch)) + 1, high - low]
            # Branches of a few documents each are one leaf together.
            start = 0
            while start < len(cuts) - 1:
                stop = start + 1
                while stop < len(cuts) - 1 and cuts[stop + 1] - cuts[start] <= self.leaf:
                    stop += 1
                waiting.append((int(cuts[start]), int(cuts[stop]), node))
                start = stop
        return root

    def best(self, terms: np.ndarray, weights: np.ndarray, kept: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of all documents that can be among the ``most`` best, given the ascending scores kept so far."""
        bounds = scores(self.most[:, terms], self.least, weights)
        worst = int(kept[0]) if len(kept) == most else 1
        found, values = [], []
        waiting = [0] if bounds[0] >= worst else []
        while waiting:
            node = waiting.pop()
            if bounds[node] < worst:
                continue
            if self.children[node]:
                waiting.extend(sorted((c for c in self.children[node] if bounds[c] >= worst), key=bounds.__getitem__))
                continue
            low, high = self.low[node], self.high[node]
            own = scores(self.tf[low:high, terms], self.m[low:high], weights)
            good = np.flatnonzero(own >= worst)
            if len(good):
                found.append(self.order[low + good])
                values.append(own[good])
                kept = np.sort(np.r_[kept, own[good]])[-most:]
                worst = int(kept[0]) if len(kept) == most else 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(values)


def scores(tf: np.ndarray, m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of each row of term frequencies with its m."""
    tf = tf.astype(np.int64)
    # Where tf is 0 so is the share, as m is at least 50.
    return ((SCALE * tf) // (TF_WEIGHT * tf + M_WEIGHT * m[:, None])) @ weights


def search_block(vectors: DataFrame, rows: list, terms: list[str], best: int, tree_docs: int) -> DataFrame:
    """The best documents of every task for the items of one block: (item_no, doc_id, score). ``vectors`` is a written table."""
    totals = vectors.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    documents, length = totals[0], totals[1] or 0
    df = np.zeros(len(terms), np.int64)
    for r in vectors.select(F.explode("ids").alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect():
        df[r["i"]] = r["n"]
    by_frequency = np.lexsort((np.arange(len(terms)), -df))
    rank = np.empty(len(terms), np.int64)
    rank[by_frequency] = np.arange(len(terms))
    weight = np.array([term_weight(documents, int(n)) for n in df], np.int64)
    asked = []
    for item_no, ids in rows:
        ids = np.array([i for i in ids if df[i]], np.int64)
        asked.append((item_no, rank[ids], weight[ids]))
    width = len(terms)
    schema = StructType([StructField("item_no", IntegerType()), StructField("doc_id", vectors.schema["doc_id"].dataType), StructField("score", LongType())])

    def search(batches):
        kept: dict[int, list] = {item_no: [] for item_no, _, _ in asked}

        def ordered(pair):
            return -pair[0], pair[1] is not None, pair[1]

        def look(table: pa.Table):
            ids = table["ids"].combine_chunks()
            tf = table["tfs"].combine_chunks()
            n = table["n"].to_numpy()
            at = np.asarray(ids.offsets).astype(np.int64)
            ranks, tf = rank[np.asarray(ids.values)[at[0] : at[-1]]], np.asarray(tf.values)[at[0] : at[-1]]
            at = at - at[0]
            row = np.repeat(np.arange(len(n)), np.diff(at))
            order = np.lexsort((ranks, row))
            m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // length
            tree = DocumentTree(at, ranks[order], tf[order], m, width)
            for item_no, own, weights in asked:
                if not len(own):
                    continue
                before = kept[item_no]
                found, values = tree.best(own, weights, np.array(sorted(s for s, _ in before), np.int64), best)
                if len(found):
                    names = table["doc_id"].take(pa.array(found)).to_pylist()
                    kept[item_no] = sorted([*before, *zip(values.tolist(), names)], key=ordered)[:best]

        held, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, tree_docs):
                part = batch.slice(start, tree_docs)
                if rows + part.num_rows > tree_docs and held:
                    look(pa.Table.from_batches(held))
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if held:
            look(pa.Table.from_batches(held))
        out = [(item_no, name, score) for item_no, pairs in kept.items() for score, name in pairs]
        if out:
            columns = list(zip(*out))
            arrow = batch.schema.field("doc_id").type
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], arrow), pa.array(columns[2], pa.int64())], names=schema.names)

    # A document without asked terms has score 0.
    return vectors.filter(F.size("ids") > 0).mapInArrow(search, schema)


def ranked_search(
    docs: DataFrame, items: DataFrame, best: int = BEST, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block_terms: int = BLOCK_TERMS, tree_docs: int = TREE_DOCS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of each item, equal scores by ascending doc_id."""
    own = items.schema[item_id].dataType
    terms = stage(item_terms(items, item_id, item_text), "item-terms")
    blocks = max(1, -(-terms.count() // block_terms))
    found = None
    for block in range(blocks):
        pairs = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        if not pairs:
            continue
        names = sorted({r["term"] for r in pairs})
        number_of = {t: i for i, t in enumerate(names)}
        of_item: dict = {}
        for r in pairs:
            of_item.setdefault(r["item_id"], []).append(number_of[r["term"]])
        ids = list(of_item)
        vectors = stage(restricted_vectors(docs, names, doc_id, text), "vectors")
        rows = [(no, of_item[i]) for no, i in enumerate(ids)]
        part = search_block(vectors, rows, names, best, tree_docs)
        item_of = docs.sparkSession.createDataFrame(list(enumerate(ids)), StructType([StructField("item_no", IntegerType()), StructField("item_id", own)]))
        named = part.withColumn("block", F.lit(block)).join(F.broadcast(item_of), "item_no")  # at most block_terms items
        found = named if found is None else found.unionByName(named)
    names = StructType([StructField("item_id", own), StructField("rank", IntegerType()), StructField(doc_id, docs.schema[doc_id].dataType), StructField("score", LongType())])
    if found is None:
        return docs.sparkSession.createDataFrame([], names)
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    # Every task brings its best; the best of groups of tasks are taken first, so that no item's candidates meet in one task.
    found = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = found.withColumn("r", F.row_number().over(Window.partitionBy("block", "item_no", "part").orderBy(*order))).filter(F.col("r") <= best)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item_no").orderBy(*order))).filter(F.col("rank") <= best)
    return ranked.select("item_id", "rank", F.col("doc_id").alias(doc_id), "score")
