"""Connected components by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); nodes of one component share their root.

    Each round hooks every node to the neighbour that comes first in the order of a hash, which is random enough for the
    number of nodes to fall by a constant factor whatever the ids are, and contracts the edges. Edges and mapping are
    written in every round; a node with many edges is summed before the shuffle. No part of the graph is collected.
    """
    edges = stage(edges.select("a", "b").filter("a != b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    mapping = stage(nodes.select("node", F.col("node").alias("root")), "nodes")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        first = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("id"))).alias("first"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("id"))
        hooked = stage(first.select("a", F.least("first", own)["id"].alias("to")), "hooked")
        mapping = stage(mapping.join(hooked, mapping["root"] == hooked["a"], "left").select("node", F.coalesce("to", "root").alias("root")), "nodes")
        one = edges.join(hooked, "a").select(F.col("to").alias("a"), "b")
        two = one.join(hooked.withColumnsRenamed({"a": "b", "to": "c"}), "b").select("a", F.col("c").alias("b"))
        low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        edges = stage(two.filter("a != b").select(low, high).distinct(), "edges")
    return mapping
