"""Exact deduplication through recipes of content-defined chunks (operator 1, DataFrame functions only).

A text is cut where its own content says so, each chunk gets an identifier, and two texts are equal when their ordered
identifier lists are. Long texts move at most once, as chunks of which every task sends a content once; all that follows
moves lists of identifiers. An identifier is a pair of 64-bit hashes that is *verified*: all chunks of one identifier are
grouped by content, and where two contents share one, they are told apart by a number.

Cases: a null text is an empty one. Rows that repeat a ``doc_id`` with an equal text each give a row and count in
``group_size``. A null ``doc_id`` stays only if its group has no other. An empty table gives no rows. Further columns are not
read, whatever their names. The result has one row per row of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import stage

BLANKS = r"[\x20\x09-\x0D]+"
# Chunks have 512 to 4096 characters and end before a blank or mark that is followed by one of a tenth of the letters.
# A text without such a place is cut every 4096 characters, which equal texts share as well.
CHUNK = r"(?s).{511,4095}?.(?=[\x09-\x2F][c-fm-pC-FM-PÀ-⿿])|.{1,4096}"


def normalised(text: Column) -> Column:
    """The text with each run of blanks replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def chunk_name(chunk: Column) -> Column:
    """128 bits of a chunk: the pair of its hashes under two seeds."""
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit("second"), chunk).alias("b"))


def chunked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_sha256 and the chunks of the normalised text, in order."""
    flat = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("flat"))
    return flat.select(
        "doc_id",
        F.sha2(F.col("flat").cast("binary"), 256).alias("text_sha256"),
        F.expr(f"regexp_extract_all(flat, r'{CHUNK}', 0)").alias("chunks"),
    )


def shared_names(chunks: DataFrame) -> DataFrame:
    """Names that stand for more than one content. Each task sends a content once, so a hot chunk is no hot group."""
    contents = chunks.select("name", "content").distinct()
    return contents.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name")


def variants(chunks: DataFrame, shared: DataFrame) -> DataFrame:
    """The contents of the shared names, with a number from 1 within the name."""
    contents = chunks.join(shared, "name", "left_semi").select("name", "content").distinct()
    order = Window.partitionBy("name").orderBy("content")
    return contents.withColumn("variant", F.row_number().over(order))


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", name=chunk_name) -> DataFrame:
    """doc_id, text_sha256 and ``recipe``, the list of verified chunk identifiers: (name, variant) in order.

    Equal lists mean equal normalised texts. ``name`` gives a chunk's unverified identifier.
    """
    cut = chunked(docs, doc_id, text)
    plain = F.transform("chunks", lambda c: F.struct(name(c).alias("name"), F.lit(0).alias("variant")))
    contents = cut.select(F.explode("chunks").alias("content")).select(name(F.col("content")).alias("name"), "content")
    shared = stage(shared_names(contents), "shared-names")
    if shared.isEmpty():
        return stage(cut.select("doc_id", "text_sha256", plain.alias("recipe")), "recipes")
    # Names that stand for several contents: their chunks are looked up by content, the lists are put together again.
    told_apart = variants(contents, shared)
    each = cut.distinct().select("doc_id", "text_sha256", F.posexplode_outer("chunks").alias("at", "content"))
    each = each.withColumn("name", F.when(F.col("content").isNotNull(), name(F.col("content"))))
    found = each.join(told_apart, ["name", "content"], "left").withColumn("variant", F.coalesce("variant", F.lit(0)))
    item = F.struct("at", "name", "variant")
    listed = found.groupBy("doc_id", "text_sha256").agg(F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), item))).alias("l"))
    bare = F.transform("l", lambda x: F.struct(x["name"].alias("name"), x["variant"].alias("variant")))
    rows = cut.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("times"))
    same = rows["doc_id"].eqNullSafe(listed["doc_id"]) & (rows["text_sha256"] == listed["text_sha256"])
    every = rows.join(listed, same).select(rows["doc_id"], rows["text_sha256"], bare.alias("recipe"), F.expr("explode(sequence(1L, times))"))
    return stage(every.drop("col"), "recipes")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", name=chunk_name) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: of equal texts the smallest doc_id stays."""
    listed = recipes(docs, doc_id, text, name)
    groups = stage(listed.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    # The side of the documents may be hot in one recipe; it is light, and Spark can split it, as both sides are plain tables.
    return listed.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with further underscores if ``df`` has such a column (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without copies: whole rows of the documents that stay; of rows that repeat one of them, one stays."""
    found = exact_duplicates(docs, doc_id, text).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    digest = free_name(docs, "_text_sha256")
    marked = docs.withColumn(digest, F.sha2(normalised(F.col(text)).cast("binary"), 256))
    same = marked[doc_id].eqNullSafe(found["_id"]) & (marked[digest] == found["_sha"])
    return marked.join(found, same, "left_semi").dropDuplicates([doc_id, digest]).drop(digest)
