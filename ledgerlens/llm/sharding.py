"""Balanced label propagation: shards of even row counts that keep linked documents together (operator 4, joins).

Documents are linked when their texts are equal. A group larger than a shard fills whole shards, and what is left of it
goes to one further shard with room, so it spans no more shards than it must. Other linked documents start evenly dealt over
the room that is left. In each round every one of them looks
through a join at the shards of its group and wants to move to the shard that holds most of it. Wishes are counted by
(from, to, cell), where a cell is a hash range of groups - of documents, if a group is too large for a shard. The counts
are bounded by shards^2 x cells; from them whole cells are admitted as far as every shard's quota allows, so a group moves
as one. Rounds end when nothing moves. Documents without links then fill each shard to its exact count.

Law: ``rows``, the counts of two shards are at most one apart. Slots number the rows of a shard from 0 without gaps: rows
are counted in slices of a hash, and only a slice is ordered.

Cases: null texts have no bytes and checksum 0 and are linked with empty ones. A row with a null doc_id is placed like any
other. Repeated rows are rows of their own. An empty table gives no rows. Further columns are not read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import stage

SHARDS, ROUNDS, CELLS = 40, 10, 16
SLICE_ROWS = 20_000
GROUP = ["ga", "gb"]


def light_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the group (128 bits of the text): all that is known of a document from here on."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id", (F.octet_length(raw) + 16).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.xxhash64(raw).alias("ga"), F.xxhash64(F.lit("second"), raw).alias("gb"),
    )


def numbered(rows: DataFrame, name: str, within: str | None, n: int) -> DataFrame:
    """``rows`` with gapless numbers from 0, for each value of ``within``. ``n`` is about the number of rows."""
    slices = max(1, -(-n // SLICE_ROWS))
    key = [within] if within else []
    cut = rows.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "ga"), F.lit(slices)))
    counts = cut.groupBy(*key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*key, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    order = Window.partitionBy(*key, "_slice").orderBy("doc_id", "ga", "gb")
    placed = cut.join(starts, [*key, "_slice"]).withColumn(name, F.col("_start") + F.row_number().over(order) - 1)
    return placed.drop("_slice", "_start")


def admitted(cells: np.ndarray, load: np.ndarray, quota: np.ndarray) -> np.ndarray:
    """Which of the wishes (from, to, cell, count) can be granted so that no shard exceeds its quota.

    Starts with all of them and takes back the smallest into a shard that is too full, which may fill the shard they leave.
    """
    granted = np.ones(len(cells), bool)
    load = load + np.bincount(cells[:, 1], cells[:, 3], len(load)) - np.bincount(cells[:, 0], cells[:, 3], len(load))
    into = {s: sorted(np.flatnonzero(cells[:, 1] == s), key=lambda i: -cells[i, 3]) for s in range(len(load))}
    full = [s for s in range(len(load)) if load[s] > quota[s]]
    while full:
        s = full.pop()
        while load[s] > quota[s]:
            i = into[s].pop()
            granted[i] = False
            load[s] -= cells[i, 3]
            load[cells[i, 0]] += cells[i, 3]
            full.append(cells[i, 0])
    return granted


def filled(sizes: list[int], quota: np.ndarray) -> list[list[tuple[int, int]]]:
    """(shard, rows) of each group of ``sizes``, all larger than a shard: whole shards, then the rest in one shard if it fits.

    The rests, largest first, go to the fullest shard that holds them; a rest that fits nowhere is cut at the emptiest ones.
    """
    room, out, rests, s = quota.astype(np.int64).copy(), [], [], 0
    for g, size in enumerate(sizes):
        own = []
        while s < len(room) and 0 < room[s] <= size:
            own.append((s, int(room[s])))
            size -= own[-1][1]
            room[s] = 0
            s += 1
        out.append(own)
        rests.append((size, g))
    for size, g in sorted(rests, reverse=True):
        while size:
            fits = np.flatnonzero(room >= size)
            to = fits[room[fits].argmin()] if len(fits) else room.argmax()
            out[g].append((int(to), int(min(size, room[to]))))
            size -= out[g][-1][1]
            room[to] -= out[g][-1][1]
    return out


def even(n: int, room: np.ndarray) -> np.ndarray:
    """How many of ``n`` rows each shard gets when they are dealt as evenly as the room allows."""
    level = bisect_left(range(int(room.max(initial=0))), n, key=lambda v: int(np.minimum(room, v).sum()))
    dealt = np.minimum(room, level)
    over = int(dealt.sum()) - n
    dealt[np.flatnonzero(dealt == level)[len(dealt[dealt == level]) - over :]] -= 1
    return dealt


def passed(sums: np.ndarray, at: str):
    """The number of the part, of those with the given sizes in a row, in which position ``at`` lies."""
    ends = F.array(*map(F.lit, np.cumsum(sums).tolist()))
    return F.size(F.filter(ends, lambda end: end <= F.col(at)))


def propagate(linked: DataFrame, quota: np.ndarray, rounds: int) -> DataFrame:
    """``linked`` (with shard) after the rounds; its rows per shard stay within the quota."""
    spark, shards = linked.sparkSession, len(quota)
    for _ in range(rounds):
        sums = linked.groupBy(*GROUP, "shard").agg(F.count(F.lit(1)).alias("n"))
        choice = F.struct("n", F.xxhash64("ga", "shard").alias("h"))
        wanted = sums.groupBy(*GROUP).agg(F.max_by("shard", choice).alias("to"), F.sum("n").alias("members"))
        wanted = stage(wanted, "wanted")
        own_cell = F.when(F.col("members") * 8 > F.lit(int(quota.max())), F.xxhash64("doc_id")).otherwise(F.lit(0))
        cell = F.pmod(F.xxhash64("ga", own_cell), F.lit(CELLS))
        wishes = stage(linked.join(wanted, GROUP).withColumn("cell", cell).drop("members"), "wishes")
        rows = wishes.groupBy("shard", "to", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
        table = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 4)
        load = np.bincount(table[:, 0], table[:, 3], shards)
        cells = table[table[:, 0] != table[:, 1]]
        granted = cells[admitted(cells, load, quota)]
        if not len(granted):
            break
        moves = spark.createDataFrame(granted[:, :3].tolist(), "shard int, to int, cell bigint").withColumn("moves", F.lit(True))
        moved = wishes.join(F.broadcast(moves), ["shard", "to", "cell"], "left")
        linked = moved.withColumn("shard", F.when(F.col("moves"), F.col("to")).otherwise(F.col("shard"))).select(*linked.columns)
        linked = stage(linked, "labels")
    return linked


def shards_of(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    rows = stage(light_rows(docs), "light")
    n = rows.count()
    columns = ["doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard")]
    columns += [F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")]
    quota = np.array([n // shards + (s < n % shards) for s in range(shards)], np.int64)
    groups = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    groups = stage(groups, "groups")  # a plain table, so that Spark can split a large group in the join
    marked = stage(rows.join(groups, GROUP, "left"), "marked")
    # Groups larger than a shard are fewer than the shards.
    most = int(quota.max())
    large = groups.filter(F.col("members") > most).orderBy(F.desc("members"), *GROUP).collect()
    pieces = [piece for own in filled([g["members"] for g in large], quota) for piece in own]
    room = quota.copy()
    for shard, size in pieces:
        room[shard] -= size
    starts = np.cumsum([0] + [g["members"] for g in large]).tolist()
    first = rows.sparkSession.createDataFrame([(g["ga"], g["gb"], at) for g, at in zip(large, starts)], "ga bigint, gb bigint, first bigint")
    hot = marked.filter(F.col("members") > most).drop("members").join(F.broadcast(first), GROUP)
    hot = numbered(hot, "at", "first", n).withColumn("at", F.col("at") + F.col("first")).drop("first")
    shard_of = F.array(*[F.lit(shard) for shard, _ in pieces]).cast("array<int>")
    hot = hot.withColumn("shard", F.get(shard_of, passed(np.array([size for _, size in pieces], np.int64), "at"))).drop("at")
    linked = numbered(marked.filter(F.col("members") <= most).drop("members"), "at", None, n)
    dealt = even(groups.filter(F.col("members") <= most).agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0], room)
    linked = stage(linked.withColumn("shard", passed(dealt, "at")).drop("at"), "labels")
    linked = propagate(linked, room, rounds)
    load = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    rest = numbered(marked.filter("members IS NULL").drop("members"), "at", None, n)
    left = np.array([int(room[s]) - load.get(s, 0) for s in range(shards)], np.int64)
    rest = rest.withColumn("shard", passed(left, "at")).drop("at")
    linked = linked.unionByName(hot.select(*linked.columns))
    return numbered(stage(linked.unionByName(rest), "placed"), "slot", "shard", n).select(*columns)
