"""Labels, exact splits, folds and samples.

Rows are ordered by a hash of a seed and their key. A part of a split is a range of that order, and the range limits
are found from counts per hash bucket, so no task ever sorts a whole class and the wide rows are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import small

# Return threshold and split sizes.
RETURN_THRESHOLD = 0.05
TEST_SIZE = 0.2
VAL_SIZE = 0.15
SEED = 42

HASH_DIGITS = 4  # 65,536 buckets per class


def add_label(df: DataFrame, column: str = "BHAR0_2", threshold: float = RETURN_THRESHOLD) -> DataFrame:
    """1 when the return is above the threshold, else 0, also for a missing return, which NaN is.

    A table without the return column is given back unchanged.
    """
    if column.lower() not in [c.lower() for c in df.columns]:
        return df
    return df.withColumn("label", above(column, threshold))


def above(column: str, threshold: float) -> Column:
    """1 above the threshold, else 0. Spark orders NaN above all numbers, so it is asked for first."""
    return F.when(~F.isnan(column) & (F.col(column) > threshold), 1).otherwise(0)


def row_hash(key: Column | str, seed: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def _bucketed(df: DataFrame, key: str, label: Column, seed: int) -> DataFrame:
    hashed = df.select(label.alias("_label"), row_hash(key, seed).alias("_hash"))
    return hashed.withColumn("_bucket", F.substring("_hash", 1, HASH_DIGITS))


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_size"))


def largest_remainder(size: str, wanted: Column) -> Column:
    """Share out ``wanted`` rows over the classes in proportion to ``size``: floors, then the largest fractions."""
    everything = Window.partitionBy(F.lit(1))
    share = F.col(size) * wanted / F.sum(size).over(everything)
    floor = F.floor(share)
    missing = wanted - F.sum(floor).over(everything)
    rank = F.row_number().over(everything.orderBy((share - floor).desc(), F.col("_label")))
    return floor + F.when(rank <= missing, 1).otherwise(0)


def split_quotas(sizes: DataFrame, test_size: float, val_size: float) -> DataFrame:
    """Rows per class for the test part, and for the validation part out of the rest. One row per class."""
    everything = Window.partitionBy(F.lit(1))
    n_test = F.ceil(F.sum("_size").over(everything) * F.lit(test_size))
    with_test = sizes.withColumn("_n_test", n_test)
    with_test = with_test.withColumn("test", largest_remainder("_size", F.col("_n_test")))
    rest = with_test.withColumn("_rest", F.col("_size") - F.col("test"))
    n_val = F.ceil(F.sum("_rest").over(everything) * F.lit(val_size))
    rest = rest.withColumn("_n_val", n_val)
    return rest.select("_label", "_size", "test", largest_remainder("_rest", F.col("_n_val")).alias("val"))


def _class_name(label: Column) -> Column:
    return F.coalesce(label.cast("string"), F.lit("\\N"))


def assign_parts(df: DataFrame, key: str, label: Column, limits: DataFrame, seed: int, output: str) -> DataFrame:
    """Put the rows of each class into consecutive parts of their hash order.

    ``limits`` has ``(_label, part, upto)``: a part ends with the row of that number in its class. Keys must be unique.
    Three narrow scans find the hash at each limit; the table itself is then only mapped. Rows without a label are a
    class of their own.
    """
    label = _class_name(label)
    limits = limits.withColumn("_label", _class_name(F.col("_label")))
    keyed = _bucketed(df, key, label, seed)
    counts = keyed.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy("_label").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.withColumn("_end", F.sum("_n").over(running))
    hit = ends.join(limits.where("upto > 0"), "_label").where("upto > _end - _n and upto <= _end")
    inside = hit.select("_label", "_bucket", "part", "upto", (F.col("upto") - F.col("_end") + F.col("_n")).alias("_at"))
    # A class has one row per part; the bucket that holds a limit is the only one whose rows are ordered.
    buckets = small(inside)
    candidates = keyed.join(buckets.select("_label", "_bucket").distinct(), ["_label", "_bucket"], "left_semi")
    order = Window.partitionBy("_label", "_bucket").orderBy("_hash")
    numbered = candidates.withColumn("_at", F.row_number().over(order))
    cuts = numbered.join(buckets, ["_label", "_bucket", "_at"])
    per_class = cuts.groupBy("_label").agg(
        F.sort_array(F.collect_list(F.struct("upto", "_hash", "part"))).alias("_cuts")
    )
    labelled = df.withColumn("_label", label)
    joined = labelled.join(small(per_class), "_label", "left")
    own = row_hash(key, seed)
    first = F.get(F.filter("_cuts", lambda cut: own <= cut["_hash"]), F.lit(0))
    return joined.withColumn(output, first["part"]).drop("_label", "_cuts")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = "label",
    test_size: float = TEST_SIZE,
    val_size: float = VAL_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Exact stratified split into ``test``, ``val`` (a share of the rest) and ``train``."""
    quotas = split_quotas(class_sizes(df, label), test_size, val_size)
    limits = quotas.select(
        "_label",
        F.inline(
            F.array(
                F.struct(F.lit("test").alias("part"), F.col("test").alias("upto")),
                F.struct(F.lit("val").alias("part"), (F.col("test") + F.col("val")).alias("upto")),
                F.struct(F.lit("train").alias("part"), F.col("_size").alias("upto")),
            )
        ),
    )
    # A part without rows ends where the part before it ends; the earlier part keeps the row.
    limits = limits.groupBy("_label", "upto").agg(F.max_by("part", _part_rank()).alias("part"))
    return assign_parts(df, key, F.col(label), limits, seed, "split")


def random_split(
    df: DataFrame, key: str, test_size: float = TEST_SIZE, val_size: float = VAL_SIZE, seed: int = SEED
) -> DataFrame:
    """The same split for a table without a label."""
    return stratified_split(df.withColumn("_all", F.lit(0)), key, "_all", test_size, val_size, seed).drop("_all")


def _part_rank() -> Column:
    return F.when(F.col("part") == "test", 3).when(F.col("part") == "val", 2).otherwise(1)


def folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """Exact stratified folds ``0 .. k-1`` in column ``fold``."""
    sizes = class_sizes(df, label)
    parts = F.transform(
        F.sequence(F.lit(1), F.lit(k)),
        lambda i: F.struct((i - 1).alias("part"), F.floor(F.col("_size") * i / k).alias("upto")),
    )
    limits = sizes.select("_label", F.inline(parts))
    limits = limits.groupBy("_label", "upto").agg(F.min("part").alias("part"))
    return assign_parts(df, key, F.col(label), limits, seed, "fold")


def exact_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), the same for a seed whatever the partitioning (E5)."""
    limits = df.sparkSession.createDataFrame([("all", n)], "_label string, upto long")
    total = df.count()
    limits = limits.select("_label", F.lit(1).alias("part"), F.least("upto", F.lit(total)).alias("upto"))
    return assign_parts(df, key, F.lit("all"), limits, seed, "_part").where("_part = 1").drop("_part")


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share of positive labels, in percent, per part of the split (D3)."""
    share = F.avg(label) * 100 if label in df.columns else F.lit(None).cast("double")
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), share.alias("positive_share"))
