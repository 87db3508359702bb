"""Benchmark decontamination by a distributed positional inverted index (operator 13, Arrow tasks and joins).

The index is a written table. Documents are taken in segments of whole texts of about ``SEGMENT_BYTES``; each segment has one
row for every term, with the positions of all its occurrences as a list of variable-length differences, and one row for every
document with its number of words. Segments are what a query is run against, so positions are never shuffled by term and a
very frequent term has one bounded list in each segment.

A query takes from the index the lists of its own terms only. Phrases start from the rarest term: its positions are the
candidates, and the lists of the other terms, the rarer ones first, are intersected with them after an adjustment by their
offsets. The windows of an item that share their rarest term are one candidate, which grows to the left and the right as far
as neighbouring lists agree. Items are asked in blocks of about ``BLOCK_WORDS`` words, so what a task gets is bounded however
many items there are.

Cases: words are runs of digits, letters and characters beyond ASCII, with A to Z lowered. A null or empty text has no words; an
item without words asks nothing. Items that share an item_id count once; those without an item_id are asked, but the digest of
a document's items, and their number, leave them out. Rows that repeat a doc_id are documents of their own. Empty tables give no
matches. Only the columns named by the arguments are read, whatever the names of others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ledgerlens.llm.words import SEGMENT_BYTES, word_blocks
from ledgerlens.session import small, stage

WINDOW_WORDS = 10
# Items are asked in blocks of about this many words.
BLOCK_WORDS = 200_000


def packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**35 in seven-bit groups, the low ones first: the bytes, and where each number begins and the last ends."""
    size = 1 + sum((numbers >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    at = np.zeros(len(numbers) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    out = np.zeros(at[-1], np.uint8)
    for k in range(5):
        own = size > k
        out[at[:-1][own] + k] = (numbers[own] >> 7 * k & 127) | ((size[own] > k + 1) << 7)
    return out, at


def unpacked(raw: np.ndarray) -> np.ndarray:
    """The numbers that ``packed`` made these bytes of."""
    last = raw < 128
    number = np.cumsum(last) - last
    starts = np.r_[0, np.flatnonzero(last)[:-1] + 1] if len(raw) else np.zeros(0, np.int64)
    place = np.arange(len(raw)) - starts[number]
    out = np.zeros(len(starts), np.int64)
    for k in range(5):
        own = place == k
        out[number[own]] |= (raw[own].astype(np.int64) & 127) << 7 * k
    return out


def positional_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The index of a text column as a written table (segment, doc_no, doc_id, n, term, postings).

    Rows of terms: number of occurrences and positions among the words of the segment. Rows of documents have no term: their
    number in the segment and their number of words.
    """
    own = docs.schema[doc_id].dataType
    kinds = [("segment", LongType()), ("doc_no", IntegerType()), ("doc_id", own), ("n", LongType()), ("term", StringType()), ("postings", BinaryType())]
    schema = StructType([StructField(n, t) for n, t in kinds])

    def build(batches):
        from pyspark import TaskContext

        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0)
            for block in word_blocks(batch.column(1), segment_bytes):
                rows, terms = block.last - block.first, len(block.distinct)
                counts = np.bincount(block.codes, minlength=terms)
                order = np.argsort(block.codes, kind="stable")
                heads = np.cumsum(counts) - counts
                steps = np.diff(order, prepend=0)
                steps[heads] = order[heads]
                data, at = packed(steps)
                ends = np.r_[at[heads], at[-1]]
                lists = pa.Array.from_buffers(pa.large_binary(), terms, [None, pa.py_buffer(ends), pa.py_buffer(data)])
                names = block.distinct.cast(pa.large_string()).cast(pa.string())
                here = pa.array(np.full(rows + terms, segment))
                yield pa.RecordBatch.from_arrays(
                    [
                        here,
                        pa.concat_arrays([pa.array(np.arange(rows, dtype=np.int32)), pa.nulls(terms, pa.int32())]),
                        pa.concat_arrays([ids.slice(block.first, rows), pa.nulls(terms, ids.type)]),
                        pa.array(np.r_[np.diff(block.at), counts]),
                        pa.concat_arrays([pa.nulls(rows, pa.string()), names]),
                        pa.concat_arrays([pa.nulls(rows, pa.binary()), lists.cast(pa.binary())]),
                    ],
                    names=schema.names,
                )
                segment += 1

    return stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(build, schema), "index")


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, words) of every item, words as an array in order; null ids are kept."""
    own = items.schema[item_id].dataType
    schema = StructType([StructField("item_id", own), StructField("words", ArrayType(StringType()))])

    def split(batches):
        for batch in batches:
            for block in word_blocks(batch.column(1)):
                names = block.distinct.cast(pa.large_string()).cast(pa.string()).take(pa.array(block.codes))
                words = pa.ListArray.from_arrays(pa.array(block.at.astype(np.int32)), names)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.last - block.first), words], names=["item_id", "words"])

    return items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).mapInArrow(split, schema)


def blocks_of(queries: DataFrame, words: str, limit: int):
    """The rows of ``queries`` in lists of about ``limit`` words each. Rows are dealt by their hash, so a list stays near the
    limit unless a single row is longer."""
    staged = stage(queries, "queries")
    total = staged.agg(F.sum(F.size(words))).first()[0] or 0
    parts = max(1, -(-total // limit))
    for part in range(parts):
        rows = staged.filter(F.pmod(F.xxhash64(*staged.columns), F.lit(parts)) == part).collect()
        if rows:
            yield rows


def term_counts(index: DataFrame, terms: DataFrame) -> dict[str, int]:
    """Occurrences in the whole index of those of the given terms that it has; at most as many as there are terms."""
    found = index.filter("term is not null").join(small(terms), "term", "left_semi")
    return {r["term"]: r["n"] for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def lists_by_segment(index: DataFrame, terms: DataFrame) -> DataFrame:
    """The lists of the given terms, those of a segment together, with the bounds of its documents."""
    lists = index.filter("term is not null").join(small(terms), "term", "left_semi")
    used = lists.select("segment").distinct()
    rows = index.filter("term is null").join(used, "segment", "left_semi")
    columns = ["segment", "doc_no", "n", "term", "postings"]
    return lists.select(columns).unionByName(rows.select(columns)).repartition("segment").sortWithinPartitions("segment", "doc_no", "term")


def anchors(phrases: list[np.ndarray], counts: np.ndarray, length: int) -> list[tuple]:
    """(phrase, place of the rarest term, first and last window, width) for the windows of each phrase, those that share their
    rarest term taken together. Windows with a term that the index doesn't have are left out."""
    found = []
    for number, codes in enumerate(phrases):
        width = min(length, len(codes))
        rare = counts[codes]
        previous = None
        for start in range(len(codes) - width + 1):
            window = rare[start : start + width]
            if window.min() == 0:
                continue
            place = start + int(window.argmin())
            if previous and previous[1] == place and previous[3] == start - 1:
                previous[3] = start
            else:
                found.append(previous := [number, place, start, start, width])
    return [tuple(a) for a in found]


class Segment:
    """The lists of one segment that a query needs, as one sorted array of term and position."""

    def __init__(self, rows: pa.Table, number_of: dict[str, int]):
        is_doc = np.asarray(rows["term"].is_null())
        words = rows["n"].to_numpy()[is_doc]
        self.doc_no = rows["doc_no"].to_numpy()[is_doc].astype(np.int64)
        self.bounds = np.r_[0, np.cumsum(words)]
        lists = rows.filter(rows["term"].is_valid())
        terms = np.array([number_of[t] for t in lists["term"].to_pylist()], np.int64)
        counts = lists["n"].to_numpy()
        joined = lists["postings"].combine_chunks()
        steps = unpacked(np.frombuffer(b"".join(joined.to_pylist()), np.uint8))
        heads = np.cumsum(counts) - counts
        total = np.cumsum(steps)
        base = np.where(heads > 0, total[heads - 1], 0) if len(heads) else heads
        positions = total - np.repeat(base, counts)
        self.keys = np.sort(np.repeat(terms, counts) << 32 | positions)

    def has(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Whether each term stands at its position."""
        wanted = terms << 32 | positions
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return self.keys[at] == wanted if len(self.keys) else np.zeros(len(wanted), bool)

    def positions(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the asked term, position) for all occurrences of the asked terms."""
        low, high = np.searchsorted(self.keys, terms << 32), np.searchsorted(self.keys, terms + 1 << 32)
        sizes = high - low
        owner = np.repeat(np.arange(len(terms)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]
        return owner, self.keys[at] & 0xFFFFFFFF


def segments(batches, number_of: dict[str, int]):
    """(segment id, Segment) of every segment in a stream that is sorted by segment; one segment is held at a time."""
    held: list = []
    current = None
    for batch in batches:
        ids = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(ids)) + 1
        for low, high in zip(np.r_[0, cuts], np.r_[cuts, len(ids)]):
            if high > low:
                if held and ids[low] != current:
                    yield current, Segment(pa.Table.from_batches(held), number_of)
                    held = []
                current = int(ids[low])
                held.append(batch.slice(low, high - low))
    if held:
        yield current, Segment(pa.Table.from_batches(held), number_of)


def phrase_matches(index: DataFrame, items: DataFrame, length: int = WINDOW_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(segment, doc_no, item_id, start, end): stretches of document words that are windows of ``length`` words of an item
    (``items`` as made by ``item_words``). An item with fewer words is one window. Overlapping windows of one place are one stretch.
    """
    own = items.schema["item_id"].dataType
    schema = StructType([StructField("segment", LongType()), StructField("doc_no", IntegerType()), StructField("item_id", own)])
    schema = schema.add("start", LongType()).add("end", LongType())
    spark = index.sparkSession
    found = spark.createDataFrame([], schema)
    for rows in blocks_of(items.filter(F.size("words") > 0), "words", block_words):
        ids = pa.array([r["item_id"] for r in rows])
        names = sorted({w for r in rows for w in r["words"]})
        number_of = {w: i for i, w in enumerate(names)}
        terms = spark.createDataFrame(pa.table({"term": names}).to_pandas(), "term string")
        known = term_counts(index, terms)
        counts = np.array([known.get(w, 0) for w in names])
        phrases = [np.array([number_of[w] for w in r["words"]], np.int64) for r in rows]
        begins = np.r_[0, np.cumsum([len(p) for p in phrases])]
        flat = np.concatenate(phrases)
        starts = anchors(phrases, counts, length)
        if not starts:
            continue
        item, place, low, high, width = np.array(starts, np.int64).T
        first_word = begins[item]
        # Words of every window of an anchor, the rarest first, as offsets from the anchor; the rest is repeated.
        most = int((low + width - high).max())
        core = np.zeros((len(item), most), np.int64)
        for i in range(len(item)):
            inner = np.arange(high[i], low[i] + width[i])
            inner = inner[np.argsort(counts[flat[first_word[i] + inner]], kind="stable")] - place[i]
            core[i, : len(inner)] = inner

        def search(batches):
            for name, segment in segments(batches, number_of):
                anchor, at = segment.positions(flat[first_word + place])
                doc = np.searchsorted(segment.bounds, at, "right") - 1
                begin, end = segment.bounds[doc], segment.bounds[doc + 1]

                def agrees(which, offset):
                    """Whether the candidates have the item's word at this distance from the anchor, in the same document."""
                    a, p = anchor[which], at[which] + offset
                    inside = (p >= begin[which]) & (p < end[which])
                    return inside & segment.has(flat[first_word[a] + place[a] + offset], p)

                left = np.arange(len(at))
                for k in range(most):
                    left = left[agrees(left, core[anchor[left], k])]
                anchor, at, doc, begin, end = anchor[left], at[left], doc[left], begin[left], end[left]
                reach = []
                for outer, step, limit in ((high[anchor], -1, high[anchor] - low[anchor]), ((low + width)[anchor] - 1, 1, (high - low)[anchor])):
                    run, live = np.zeros(len(at), np.int64), np.arange(len(at))
                    while len(live := live[run[live] < limit[live]]):
                        live = live[agrees(live, outer[live] + step * (run[live] + 1) - place[anchor[live]])]
                        run[live] += 1
                    reach.append(run)
                start, stop = high[anchor] - reach[0], low[anchor] + reach[1]  # first and last window that is there
                good = start <= stop
                a, p = anchor[good], at[good]
                first = p + start[good] - place[a] - begin[good]
                last = p + stop[good] + width[a] - place[a] - begin[good]
                hits = np.unique(np.stack([segment.doc_no[doc[good]], item[a], first, last]), axis=1)
                if hits.shape[1]:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(hits.shape[1], name)), pa.array(hits[0].astype(np.int32)), ids.take(pa.array(hits[1])),
                            pa.array(hits[2]), pa.array(hits[3]),
                        ],
                        names=schema.names,
                    )

        found = found.unionByName(stage(lists_by_segment(index, terms).mapInArrow(search, schema), "matches"))
    return found


def near_matches(index: DataFrame, queries: DataFrame, within: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(segment, doc_no, item_id, at): places of the rarest term of a query (``queries`` as made by ``item_words``) that have every
    other term of the query in the same document at most ``within`` words away, on either side. ``at`` counts the document's words.
    """
    own = queries.schema["item_id"].dataType
    schema = StructType([StructField("segment", LongType()), StructField("doc_no", IntegerType()), StructField("item_id", own)]).add("at", LongType())
    spark = index.sparkSession
    found = spark.createDataFrame([], schema)
    for rows in blocks_of(queries.filter(F.size("words") > 0), "words", block_words):
        ids = pa.array([r["item_id"] for r in rows])
        names = sorted({w for r in rows for w in r["words"]})
        number_of = {w: i for i, w in enumerate(names)}
        terms = spark.createDataFrame(pa.table({"term": names}).to_pandas(), "term string")
        known = term_counts(index, terms)
        asked = [sorted({number_of[w] for w in r["words"]}, key=lambda t: (known.get(names[t], 0), t)) for r in rows]
        asked = [(i, np.array(q, np.int64)) for i, q in enumerate(asked) if all(names[t] in known for t in q)]

        def search(batches):
            for name, segment in segments(batches, number_of):
                for i, query in asked:
                    _, at = segment.positions(query[:1])
                    doc = np.searchsorted(segment.bounds, at, "right") - 1
                    for term in query[1:]:
                        if not len(at):
                            break
                        _, other = segment.positions(np.array([term]))
                        low = np.maximum(at - within, segment.bounds[doc])
                        high = np.minimum(at + within, segment.bounds[doc + 1] - 1)
                        there = np.searchsorted(other, high, "right") > np.searchsorted(other, low)
                        at, doc = at[there], doc[there]
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(at), name)), pa.array(segment.doc_no[doc].astype(np.int32)),
                                ids.take(pa.array(np.full(len(at), i))), pa.array(at - segment.bounds[doc]),
                            ],
                            names=schema.names,
                        )

        found = found.unionByName(stage(lists_by_segment(index, terms).mapInArrow(search, schema), "near"))
    return found


def contamination(
    docs: DataFrame, items: DataFrame, length: int = WINDOW_WORDS, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS, segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row for each document.

    The stretches of one document are ordered and united in a window over that document alone; its items are collected, at
    most as many as the benchmark has.
    """
    index = positional_index(docs, doc_id, text, segment_bytes)
    found = phrase_matches(index, item_words(items, item_id, item_text), length, block_words)
    of_doc = Window.partitionBy("segment", "doc_no")
    before = F.max("end").over(of_doc.orderBy("start", "end", "item_id").rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0)))
    stretches = found.withColumn("new", F.greatest(new, F.lit(0)))
    listed = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    summed = stretches.groupBy("segment", "doc_no").agg(F.sum("new").alias("n_hit"), listed.alias("items"))
    rows = index.filter("term is null").select("segment", "doc_no", "doc_id", F.col("n").alias("n_words"))
    joined = rows.join(stage(summed, "hits"), ["segment", "doc_no"], "left")
    named = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        F.col("doc_id").alias(doc_id), "n_words", hit.alias("n_hit"), F.size(named).cast("long").alias("n_items"),
        F.sha2(F.array_join(named, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
