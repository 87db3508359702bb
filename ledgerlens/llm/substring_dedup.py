"""Removal of repeated passages by induced sorting of sampled suffixes (operator 3, NumPy tasks and joins).

A passage of ``length`` bytes that starts at two places of the corpus is removed at all of them. Sorting every suffix of the
corpus is not needed for that, so the induction starts from a sample and goes only where it can find something:

1. Anchors. Every window of ``length`` bytes has one sampled suffix, the one at its ``gram`` with the smallest hash. It depends
   on the window's bytes alone, so equal windows have equal anchors at equal distances. Anchors whose gram is found once
   in the corpus can't lie in a repeated window; Spark's shuffle counts them and they end here.
2. Territories. The windows of one anchor are consecutive. Where the whole stretch of bytes that they cover is found again,
   all of them are repeated; the stretches are named by 128-bit digests and counted.
3. Induction. What is left is sorted by anchor: the suffixes that begin at the anchors of one gram are sorted with their
   common-prefix lengths, and from each order that of the suffixes one byte further left is induced by a stable sort on
   that byte, the common prefixes by range minima, until the territories end. Suffixes with ``length`` bytes in common are
   repeated windows. Each different stretch takes part once, however often it was found.

Groups of more than ``GROUP_CONTEXTS`` different stretches are not sorted in one task; their windows are counted by digest
over all tasks instead, which gives the same windows. All sorting between tasks is Spark's, on disk where memory ends.

Cases: null texts are empty. Matches never cross documents. Rows that repeat a doc_id or a whole row are documents of their
own, so a repeated row of enough bytes is removed in both places. An empty table gives no rows. Columns other than doc_id and
text are not read, whatever their names.
"""

from __future__ import annotations

import uuid
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.arrays import mixed, numbers, text_blocks
from ledgerlens.session import shared_folder, stage

LENGTH, GRAM = 400, 200
SEGMENT = 2_000_000
GROUP_CONTEXTS, BATCH_CONTEXTS = 20_000, 20_000
BASE = 0x9E3779B97F4A7C15


def powers(n: int, base: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base % 2**64, np.uint64))])


class Anchors:
    """Finds the territories of texts."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.value = numbers(256, 41)
        self.size = 0

    def _grams(self, raw: np.ndarray) -> np.ndarray:
        """A well-mixed hash of the gram at each position."""
        if self.size < len(raw):
            self.size = len(raw)
            self.up, self.down = powers(self.size, BASE), powers(self.size, pow(BASE, -1, 2**64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.value[raw] * self.up[: len(raw)])])
        return mixed((total[self.gram :] - total[: -self.gram]) * self.down[: len(raw) - self.gram + 1])

    def _segment(self, raw: np.ndarray, at: np.ndarray):
        """Territories of texts of less than 2^24 bytes together: text, first window, windows, anchor, hash of the gram."""
        none = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
        windows = np.maximum(np.diff(at) - self.length + 1, 0)
        if not windows.sum():
            return none
        grams = self._grams(raw)
        # The place is in the low bits, so the first of equal grams wins and the minimum names it.
        least = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        width, wanted = 1, self.length - self.gram + 1
        while 2 * width <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wanted:
            least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
        text = np.repeat(np.arange(len(windows)), windows)
        start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + at[:-1][text]
        anchor = (least[start] & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.ones(len(text), bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(first)
        row, count = text[first], np.diff(np.append(first, len(text)))
        return [row, start[first] - at[row], count, anchor[first] - at[row], grams[anchor[first]]]

    def of(self, raw: np.ndarray, at: np.ndarray):
        if len(raw) <= SEGMENT or len(at) > 2:
            return self._segment(raw, at)
        parts = []  # one long text: segments that share a window less one byte
        for begin in range(0, max(1, len(raw) - self.length + 1), SEGMENT):
            piece = raw[begin : begin + SEGMENT + self.length - 1]
            row, start, count, anchor, gram = self._segment(piece, np.array([0, len(piece)]))
            parts.append([row, start + begin, count, anchor + begin, gram])
        return [np.concatenate(x) for x in zip(*parts)]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and two 64-bit keys of the row."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", raw.alias("text"))
    return rows.withColumn("key", F.xxhash64("doc_id", "text")).withColumn("key2", F.xxhash64(F.lit("second"), "doc_id", "text"))


def anchor_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, key): one row for each territory."""

    def work(batches):
        find = Anchors(length, gram)
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for first, _, raw, at in text_blocks(batch.column(1)):
                row, _, _, _, grams = find.of(raw, at)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(keys[first + row])], ["gram", "key"])

    return rows.select("key", "text").mapInArrow(work, "gram bigint, key bigint")


def suspects(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows with an anchor that is found twice, and those anchors: written in buckets of the key, which later joins share."""
    spark = rows.sparkSession
    found = stage(anchor_rows(rows, length, gram), "anchors")
    # Written first: both sides of the join are then plain tables, and Spark can split a gram that is found very often.
    twice = stage(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "found-twice")
    listed = found.join(twice, "gram").groupBy("key").agg(F.collect_set("gram").alias("grams"))
    name = f"suspects_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/ledgerlens/{spark.sparkContext.applicationId}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.join(listed, "key").write.bucketBy(buckets, "key").option("path", path).saveAsTable(name)
    return spark.table(name)


def territories(bucketed: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, stretch, key, key2, start, count) of the territories whose anchor is found twice."""

    def work(batches):
        find = Anchors(length, gram)
        for batch in batches:
            for first, _, raw, at in text_blocks(batch.column(2)):
                row, start, count, _, grams = find.of(raw, at)
                out = []
                for i in range(len(at) - 1):
                    low, high = np.searchsorted(row, [i, i + 1])
                    known = np.array(batch.column(3)[first + i].as_py(), np.int64).view(np.uint64)
                    text = raw[at[i] : at[i + 1]].tobytes()
                    key, key2 = batch.column(0)[first + i].as_py(), batch.column(1)[first + i].as_py()
                    for j in low + np.flatnonzero(np.isin(grams[low:high], known)):
                        a, n = int(start[j]), int(count[j])
                        name = blake2b(text[a : a + n + length - 1], digest_size=16).digest()
                        out.append((int(grams[j].view(np.int64)), name, key, key2, a, n))
                columns = list(zip(*out)) if out else [[]] * 6
                kinds = [pa.int64(), pa.binary(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["gram", "stretch", "key", "key2", "start", "count"])

    columns = "gram bigint, stretch binary, key bigint, key2 bigint, start bigint, count bigint"
    return bucketed.select("key", "key2", "text", "grams").mapInArrow(work, columns)


def contexts(bucketed: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, large, key, key2, start, count, ahead, bytes) of the wanted territories; ahead: from the first window to the anchor."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("key2", "start", "large")).alias("wanted"))
    joined = bucketed.join(lists, "key").select("key", "key2", "text", "wanted")

    def work(batches):
        find = Anchors(length, gram)
        for batch in batches:
            for first, _, raw, at in text_blocks(batch.column(2)):
                row, start, count, anchor, grams = find.of(raw, at)
                out = []
                for i in range(len(at) - 1):
                    key, key2 = batch.column(0)[first + i].as_py(), batch.column(1)[first + i].as_py()
                    large = {w["start"]: w["large"] for w in batch.column(3)[first + i].as_py() if w["key2"] == key2}
                    low, high = np.searchsorted(row, [i, i + 1])
                    text = raw[at[i] : at[i + 1]].tobytes()
                    for j in low + np.flatnonzero(np.isin(start[low:high], list(large))):
                        a, n = int(start[j]), int(count[j])
                        out.append((int(grams[j].view(np.int64)), large[a], key, key2, a, n, int(anchor[j]) - a, text[a : a + n + length - 1]))
                columns = list(zip(*out)) if out else [[]] * 8
                kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 5, pa.binary()]
                names = ["gram", "large", "key", "key2", "start", "count", "ahead", "bytes"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    schema = "gram bigint, large boolean, key bigint, key2 bigint, start bigint, count bigint, ahead bigint, bytes binary"
    return joined.mapInArrow(work, schema)


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low..high]) of each pair, low <= high."""
    table = [values]
    while 2 ** len(table) <= len(values):
        half = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.floor(np.log2(high - low + 1)).astype(np.int64)
    out = np.empty(len(low), values.dtype)
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(table[k][low[own]], table[k][high[own] - 2**k + 1])
    return out


def induced(group: np.ndarray, first: np.ndarray, last: np.ndarray, data: list[bytes], length: int) -> list[tuple[int, int]]:
    """(row, distance) of the windows that two or more rows of a group share.

    Row r holds the bytes from ``last`` before its anchor on, and its windows begin ``first`` to ``last`` bytes before it.
    """
    n, deepest = len(data), int(last.max())
    right, left = np.zeros((n, length), np.uint8), np.zeros((n, deepest), np.uint8)
    for i, raw in enumerate(data):
        row = np.frombuffer(raw, np.uint8)
        own = row[last[i] : last[i] + length]
        right[i, : len(own)] = own
        left[i, : last[i]] = row[: last[i]][::-1]
    # Suffixes at the anchors, by group and bytes, and the common prefixes of neighbours.
    key = np.concatenate([group.astype(">u4").view(np.uint8).reshape(n, 4), right], axis=1)
    order = np.argsort(np.ascontiguousarray(key).view(f"V{length + 4}").ravel(), kind="stable")
    differ = key[order[1:]] != key[order[:-1]]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), length + 4) - 4
    prefix = np.concatenate([[-1], np.where(differ[:, :4].any(axis=1), -1, prefix)]).astype(np.int64)
    found = []
    for distance in range(deepest + 1):
        if distance:
            # The order one byte further left: stable by that byte within the group, without the rows that have ended.
            stays = np.flatnonzero(last[order] >= distance)
            kept = order[stays]
            sort = np.lexsort((left[kept, distance - 1], group[kept]))
            place, new = stays[sort], kept[sort]
            same = (group[new[1:]] == group[new[:-1]]) & (left[new[1:], distance - 1] == left[new[:-1], distance - 1])
            grown = np.full(len(new), -1, np.int64)
            grown[1:] = np.where(group[new[1:]] == group[new[:-1]], 0, -1)
            if same.any():
                grown[1:][same] = 1 + range_minima(prefix, place[:-1][same] + 1, place[1:][same])
            order, prefix = new, grown
        if not len(order):
            break
        share = np.cumsum(prefix < length)  # a number for each set of suffixes that agree in so many bytes
        inside = first[order] <= distance
        count = np.bincount(share, inside)
        found += [(int(r), distance) for r in order[inside & (count[share] > 1)]]
    return found


def sorted_groups(rows: DataFrame, length: int) -> DataFrame:
    """(key, key2, start, count): repeated windows of groups that are sorted in tasks."""

    def work(batches):
        held: list[tuple] = []

        def answer(rows):
            names = {g: i for i, g in enumerate(dict.fromkeys(r[0] for r in rows))}
            group = np.array([names[r[0]] for r in rows], np.int64)
            ahead, count = np.array([r[5] for r in rows]), np.array([r[4] for r in rows])
            pairs = induced(group, ahead - count + 1, ahead, [r[6] for r in rows], length)
            out = [(rows[r][1], rows[r][2], rows[r][3] + int(ahead[r]) - d, 1) for r, d in pairs]
            columns = list(zip(*out)) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["key", "key2", "start", "count"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= BATCH_CONTEXTS and row[0] != held[-1][0]:
                    yield answer(held)
                    held = []
                held.append(row)
        if held:
            yield answer(held)

    dealt = rows.select("gram", "key", "key2", "start", "count", "ahead", "bytes").repartition("gram").sortWithinPartitions("gram", "key", "start")
    return dealt.mapInArrow(work, "key bigint, key2 bigint, start bigint, count bigint")


def counted_windows(rows: DataFrame, length: int) -> DataFrame:
    """The same windows for groups of any size: each window by its digest, counted over all tasks."""

    def work(batches):
        for batch in batches:
            out = []
            for key, key2, start, count, raw in zip(*(c.to_pylist() for c in batch.columns)):
                out += [(blake2b(raw[i : i + length], digest_size=16).digest(), key, key2, start + i) for i in range(count)]
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = [pa.binary(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["window", "key", "key2", "start"])

    each = stage(rows.select("key", "key2", "start", "count", "bytes").mapInArrow(work, "window binary, key bigint, key2 bigint, start bigint"), "windows")
    twice = stage(each.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window"), "found-twice")
    return each.join(twice, "window").select("key", "key2", "start", F.lit(1).cast("bigint").alias("count"))


def repeated_windows(bucketed: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, key2, start, count): windows that start anywhere else as well."""
    every = stage(territories(bucketed, length, gram), "territories")
    stretches = every.groupBy("gram", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "key2", "start")).alias("one")
    )
    stretches = stage(stretches, "stretches")
    whole = every.join(stretches.filter("n > 1").select("gram", "stretch"), ["gram", "stretch"]).select("key", "key2", "start", "count")
    # Anchors with a stretch that was found once: their different stretches are compared, one place for each.
    open_grams = stretches.groupBy("gram").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least")).filter("least = 1 AND size > 1")
    open_grams = stage(open_grams, "open-grams")
    wanted = stretches.join(open_grams, "gram").select("one.*", (F.col("size") > GROUP_CONTEXTS).alias("large"))
    found = stage(contexts(bucketed, wanted, length, gram), "contexts")
    # What a shared stretch's single place finds is repeated in all of its places already.
    return whole.unionByName(sorted_groups(found.filter("NOT large"), length)).unionByName(counted_windows(found.filter("large"), length))


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start and end in bytes of the removed runs)."""
    rows = keyed(docs)
    bucketed = suspects(rows, length, gram)
    starts = repeated_windows(bucketed, length, gram)
    lists = starts.groupBy("key").agg(F.collect_set(F.struct("key2", "start", "count")).alias("starts"))
    joined = bucketed.join(lists, "key").select("key", "key2", "text", "starts")

    def cut(batches):
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                key, key2 = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                own = sorted((s["start"], s["start"] + s["count"] + length - 1) for s in batch.column(3)[row].as_py() if s["key2"] == key2)
                if not own:
                    continue
                raw, runs, kept, end = batch.column(2)[row].as_py().encode(), [], sha256(), 0
                for a, b in own:
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(b, runs[-1][1])
                    else:
                        runs.append([a, b])
                for a, b in runs:
                    kept.update(raw[end:a])
                    end = b
                kept.update(raw[end:])
                out.append((key, key2, sum(b - a for a, b in runs), len(runs), kept.hexdigest(), runs))
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.list_(pa.int64()))]
            names = ["key", "key2", "n_removed", "n_spans", "kept_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    schema = "key bigint, key2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<array<bigint>>"
    # Rows that are repeated whole share their keys; one answer is theirs.
    changed = joined.mapInArrow(cut, schema).dropDuplicates(["key", "key2"])
    raw = F.col("text").cast("binary")
    light = rows.select("doc_id", "key", "key2", F.octet_length(raw).cast("bigint").alias("n_bytes"), F.sha2(raw, 256).alias("whole"))
    zero = F.lit(0).cast("bigint")
    return light.join(changed, ["key", "key2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "spans",
    )
