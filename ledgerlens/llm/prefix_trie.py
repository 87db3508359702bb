"""Trie of the prefixes of conversations by van Emde Boas recursion (operator 12, joins).

A sequence of turns is cut at half its (rounded) depth, its halves at theirs, and so on down to single turns. All pieces of one
level of the recursion, of all conversations, are worked on together, so the number of rounds is the logarithm of the depth:

* Digests of aligned pieces are made from those of their halves.
* From the largest cut to the smallest, prefixes that end at a cut are named: two conversations share the prefix if they share
  the name of the cut before it, which is the root of their lower tree, and the digest of the piece between. The name is the
  smallest conversation, so with its depth it is the node itself. Upper trees and lower forests of a level are named at once.
* From the smallest cut to the largest, the totals of lower forests are grafted upward: what lies below a node at the cut is
  added to that node and its ancestors in the upper tree. Before a round, a node's totals hold its subtree as far as its own
  piece reaches, so a node takes part in one addition for each level.

A conversation is never one row or one task: turns are numbered by ranges, groups are counted before they are shuffled, and
joins have written sides, so that Spark can split a key that holds many rows. The digest of a node's members reads them in
order as a stream of texts of ``CHUNK_IDS`` numbers each.

Cases: null role and text are empty; a null turn comes first; turns of equal number are ordered by the SHA-256 of role and text,
and repeated rows are turns of their own. Rows without conv_id are left out. A conversation whose rebuilt form has no turns is a
member of the root alone. An empty table has no nodes. Only the four columns are read, whatever the names of others.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import stage

HEADS, FAMILY = 6, 100
CHUNK_IDS = 8192


def digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, turn_digest, size): turns counted from 1 in their order, without one task for one conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = digest(F.length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", name.alias("turn_digest"), F.length(text).cast("long").alias("size")
    )
    # Rows with equal keys are in one range, so the order within and between ranges is that of the keys.
    ranged = stage(turns.repartitionByRange("conv_id", "turn", "turn_digest").withColumn("part", F.spark_partition_id()), "turns")
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stage(counts.select("conv_id", "part", before.alias("before")), "turn-offsets")
    within = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(F.asc_nulls_first("turn"), "turn_digest"))
    placed = ranged.withColumn("within", within).join(offsets, ["conv_id", "part"])
    return stage(placed.select("conv_id", (F.col("before") + F.col("within")).alias("depth"), "turn_digest", "size"), "numbered")


def rebuilt(turns: DataFrame, heads: int = HEADS, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, turn_digest, size), (conv_id, n_turns)) with the first turns of each conversation replaced.

    The first h turns come from the conversation that opens its family, where h is a hash of the id below ``heads``. So a
    conversation gives at most ``heads - 1`` turns to each of at most ``family`` others.
    """
    ids = turns.select("conv_id").distinct()
    own = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    ids = stage(ids.select("conv_id", own.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("opening")), "conversations")
    first = turns.filter((F.col("conv_id") % family == 0) & (F.col("depth") < heads)).withColumnRenamed("conv_id", "opening")
    taken = ids.join(first, "opening").filter("depth <= h").select("conv_id", "depth", "turn_digest", "size")
    taken = stage(taken, "taken")
    n_taken = taken.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_taken"))
    ids = stage(ids.join(n_taken, "conv_id", "left").select("conv_id", "h", F.coalesce("n_taken", F.lit(0)).alias("n_taken")), "conversations")
    kept = turns.join(ids, "conv_id").filter("depth > h")
    kept = kept.select("conv_id", (F.col("depth") - F.col("h") + F.col("n_taken")).alias("depth"), "turn_digest", "size")
    whole = stage(taken.unionByName(kept), "rebuilt")
    lengths = whole.groupBy("conv_id").agg(F.max("depth").alias("n"))
    return whole, stage(ids.join(lengths, "conv_id", "left").select("conv_id", F.coalesce("n", F.lit(0)).alias("n_turns")), "lengths")


def named_prefixes(turns: DataFrame) -> tuple[DataFrame, int]:
    """(conv_id, depth, name) for every prefix of every conversation, and the number of levels of the recursion.

    ``name`` is the smallest conversation that begins with the same turns.
    """
    deepest = turns.agg(F.max("depth")).first()[0] or 0
    levels = deepest.bit_length()
    piece = turns.select("conv_id", (F.col("depth") - 1).alias("piece"), F.col("turn_digest").alias("content"))
    cuts = []
    for level in range(levels):
        # The first of two pieces ends at a cut of this level.
        cuts.append(piece.filter("piece % 2 = 0").select("conv_id", ((F.col("piece") + 1) * (1 << level)).alias("depth"), "content"))
        if level + 1 < levels:
            second = F.col("piece") % 2 == 1
            halves = piece.groupBy("conv_id", F.floor(F.col("piece") / 2).alias("piece")).agg(
                F.max(F.when(~second, F.col("content"))).alias("a"), F.max(F.when(second, F.col("content"))).alias("b")
            )
            piece = stage(halves.filter("a is not null and b is not null").select("conv_id", "piece", digest(F.col("a"), F.col("b")).alias("content")), "pieces")
    names = turns.sparkSession.createDataFrame([], "conv_id long, depth long, name long")
    for level in reversed(range(levels)):
        back = F.col("depth") - (1 << level)
        own = cuts[level].withColumn("root_depth", back)
        roots = names.select("conv_id", F.col("depth").alias("root_depth"), F.col("name").alias("root"))
        # At depth 0 all conversations have the same root.
        rooted = stage(own.join(roots, ["conv_id", "root_depth"], "left").filter("root_depth = 0 or root is not null"), "rooted")
        root = F.coalesce("root", F.lit(0)).alias("root")
        rooted = rooted.select("conv_id", "depth", "content", root)
        groups = stage(rooted.groupBy("depth", "root", "content").agg(F.min("conv_id").alias("name")), "groups")
        names = names.unionByName(stage(rooted.join(groups, ["depth", "root", "content"]).select("conv_id", "depth", "name"), "names"))
    return names, levels


def subtree_totals(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """``nodes`` (conv_id, depth, parent, leaves, saved, ...) with ``leaves`` and ``saved`` summed over their subtrees."""
    for level in range(levels):
        half = 1 << level
        below = nodes.filter((F.col("depth") > half) & (F.col("depth") % (2 * half) == (half + 1) % (2 * half)))
        forest = below.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("cut")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        above = forest.withColumn("depth", F.explode(F.sequence(F.col("cut") - half + 1, F.col("cut"))))
        named = above.join(paths, ["conv_id", "depth"]).groupBy(F.col("name").alias("conv_id"), "depth")
        more = stage(named.agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved")), "grafts")
        grown = nodes.join(more, ["conv_id", "depth"], "left")
        added = [(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")]
        nodes = stage(grown.select(*[c for c in nodes.columns if c not in ("leaves", "saved")], *added), "totals")
    return nodes


def member_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which conversations end, from rows (conv_id, depth, member).

    The decimal members, ascending and joined by commas, go to the digest as a stream; ranges are joined into texts first.
    """

    def runs(batch, width):
        """(conv_id, depth) and rows of each run of equal nodes."""
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        start = 0
        for i in range(1, len(a) + 1):
            if i == len(a) or (a[i], b[i]) != (a[start], b[start]) or i - start == width:
                yield a[start], b[start], start, i
                start = i

    def texts(batches):
        for batch in batches:
            members = batch.column(2).to_pylist()
            rows = [(c, d, members[i], ",".join(map(str, members[i:j]))) for c, d, i, j in runs(batch, CHUNK_IDS)]
            columns = list(zip(*rows)) if rows else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "depth", "first", "members"])

    def hashed(batches):
        current, state = None, None
        for batch in batches:
            out = []
            for c, d, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                if (c, d) == current:
                    state.update(b"," + m.encode())
                else:
                    if current:
                        out.append((*current, state.hexdigest()))
                    current, state = (c, d), sha256(m.encode())
            yield row_batch(out)
        if current:
            yield row_batch([(*current, state.hexdigest())])

    def row_batch(rows):
        columns = list(zip(*rows)) if rows else [()] * 3
        kinds = [pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "depth", "ends_sha256"])

    ordered = ends.select("conv_id", "depth", "member").repartitionByRange("conv_id", "depth", "member").sortWithinPartitions("conv_id", "depth", "member")
    chunks = stage(ordered.mapInArrow(texts, "conv_id long, depth long, first long, members string"), "members")
    dealt = chunks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return stage(dealt.mapInArrow(hashed, "conv_id long, depth long, ends_sha256 string"), "member-digests")


def prefix_trie(conversations: DataFrame, heads: int = HEADS, family: int = FAMILY) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row for each node."""
    turns, lengths = rebuilt(numbered_turns(conversations), heads, family)
    names, levels = named_prefixes(turns)
    paths = stage(turns.join(names, ["conv_id", "depth"]).select("conv_id", "depth", "name", "size"), "paths")
    own_size = F.max(F.when(F.col("conv_id") == F.col("name"), F.col("size")))
    counted = paths.groupBy(F.col("name").alias("conv_id"), "depth").agg(F.count(F.lit(1)).alias("n_convs"), own_size.alias("size"))
    counted = stage(counted, "nodes")
    above = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    deep = counted.filter("depth > 1").join(above, ["conv_id", "depth"])
    nodes = stage(deep.unionByName(counted.filter("depth = 1").withColumn("parent", F.lit(None).cast("long"))), "nodes")
    children = nodes.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    children = stage(children, "children")
    of_node = nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    saved = (F.col("n_convs") - 1) * F.col("size")
    totals = of_node.select("conv_id", "depth", "parent", "n_convs", "n_children", (F.col("n_children") == 0).cast("long").alias("leaves"), saved.alias("saved"))
    totals = subtree_totals(stage(totals, "totals"), paths, levels)
    # The root: every conversation, also one without turns.
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    top = totals.filter("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    none = F.lit(None).cast("long")
    root = root.join(F.broadcast(top)).select(  # one row each
        "conv_id", F.lit(0).cast("long").alias("depth"), none.alias("parent"), "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
    )
    root = stage(root, "root")
    first = root.select("conv_id").first()
    smallest = F.lit(first[0] if first else None).cast("long")
    whole = totals.unionByName(root)
    ends = lengths.select("conv_id", F.col("n_turns").alias("depth")).filter("depth > 0").join(paths, ["conv_id", "depth"])
    ends = ends.select(F.col("name").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    ends = ends.unionByName(lengths.filter("n_turns = 0").select(smallest.alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member")))
    digests = member_digests(ends)
    parent = F.when(F.col("depth") == 1, smallest).otherwise(F.col("parent"))
    joined = whole.join(digests, ["conv_id", "depth"], "left")
    return joined.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
    )
