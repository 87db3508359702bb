"""Multi-line CSV read by many tasks (A1, A2).

A record of such a file may hold line breaks inside quotes, so a task that starts in the middle of the file can't see where
records begin. It can be known from the quotes alone: a line with an odd number of quotes opens or closes a quoted text, and
doubled quotes count twice. The file is therefore read as lines, which Spark splits by byte ranges:

1. The lines with an odd number of quotes are counted for each range. Prefix sums of these counts over the ranges of a file
   tell for each range whether it begins inside quotes, and in which range the record was opened.
2. Each range joins its lines to records in order and without a shuffle. Only the pieces of records that cross a range, at
   most two for each range, are shuffled and put together.

The records are parsed by Spark's own CSV parser. The table of ranges is broadcast up to ``MOST_RANGES`` rows; beyond, lines
are sorted within their range after a shuffle.

Cases: where the first line of a file ends with CRLF, line breaks CRLF inside quotes become LF, as in Spark's own reader;
in other files they are kept as they are, and a CR at the end of a record is left out. Empty lines between records are skipped.
A gzip file is one range, because it can't be split. A quote that is never closed takes the rest of its file into its record,
as in any reader of such files. Files without a record give no rows.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import stage

MOST_RANGES = 100_000
# Ranges are read one after another by a task, so that small ranges of large files don't start a task each.
TASK_BYTES = 64 << 20
RANGE = ["path", "begin", "size"]


@contextmanager
def fixed_ranges(spark: SparkSession, part_bytes: int | None):
    """Both passes see the same byte ranges, also when executors come or go between them."""
    wanted = {"spark.sql.files.minPartitionNum": str(spark.sparkContext.defaultParallelism)}
    if part_bytes:
        wanted |= {"spark.sql.files.maxPartitionBytes": str(part_bytes), "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            if part_bytes or before[name] is None:
                spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def lines(spark: SparkSession, path: str, part_bytes: int | None = None) -> DataFrame:
    """path, begin, size (of the range), row (ascending in a range), line, odd (an odd number of quotes).

    Ranges of less than ``TASK_BYTES`` share tasks, but no core is left without one.
    """
    meta = F.col("_metadata")
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    found = spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("path"), meta["file_block_start"].alias("begin"), meta["file_block_length"].alias("size"),
        F.monotonically_increasing_id().alias("row"), line.alias("line"), (quotes % 2 == 1).alias("odd"),
    )
    if not part_bytes:
        return found
    count = found.rdd.getNumPartitions()
    return found.coalesce(max(1, min(count, max(2 * spark.sparkContext.defaultParallelism, -(-count * part_bytes // TASK_BYTES)))))


def ranges(rows: DataFrame) -> DataFrame:
    """path, begin, size, number, inside (begins in quotes), owner (number of the range that opened them), first (of its file
    with a line that is not empty), crlf (how the first line of its file ends)."""
    filled = ~F.col("line").isin("", "\r")
    counts = rows.groupBy(*RANGE).agg(F.count_if("odd").alias("n_odd"), F.max(filled).alias("filled"), F.min_by(F.col("line").endswith("\r"), "row").alias("cr"))
    numbered = stage(counts.withColumn("number", F.monotonically_increasing_id()), "csv-ranges")
    before = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_odd").over(before) % 2 == 1, F.lit(False))
    owner = F.last(F.when(F.col("n_odd") > 0, F.col("number")), ignorenulls=True).over(before)
    first = F.col("filled") & ~F.coalesce(F.max("filled").over(before), F.lit(False))
    crlf = F.first("cr").over(Window.partitionBy("path").orderBy("begin"))
    return numbered.select(*RANGE, "number", crlf.alias("crlf"), inside.alias("inside"), owner.alias("owner"), first.alias("first"))


def records(rows: DataFrame) -> DataFrame:
    """owner, begin, header, record. Whole records have no owner; pieces have the range their record was opened in.

    The rows of a range stand together and in order.
    """
    names = ["owner", "begin", "header", "record"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def work(batches):
        number = None
        begin = inside = owner = open_now = header_due = at_start = None
        pending: list[pa.Array] = []

        def joined(parts: list[pa.Array], ends: np.ndarray) -> pa.Array:
            """The lines of ``parts`` joined to records that end behind the lines ``ends``."""
            flat = pa.concat_arrays(parts)
            offsets = pa.array(np.concatenate([[0], ends + 1]), pa.int32())
            return pc.binary_join(pa.ListArray.from_arrays(offsets, flat), b"\n")

        def rows_of(record: pa.Array, owners: list, headers: list):
            return pa.RecordBatch.from_arrays(
                [pa.array(owners, kinds[0]), pa.array([begin] * len(record), kinds[1]), pa.array(headers, kinds[2]), record.cast(kinds[3])], names
            )

        def answer(record: pa.Array):
            """Records that ended in this range: the first may have been opened before it, and one may be the header."""
            nonlocal header_due, at_start
            owners, headers = [None] * len(record), [False] * len(record)
            if at_start and inside:
                owners[0] = owner
            at_start = False
            if header_due:
                for i, text in enumerate(record):
                    if text.as_py() not in (b"", b"\r"):
                        headers[i], header_due = True, False
                        break
            return rows_of(record, owners, headers)

        def rest():
            """The piece of a record that the end of the range cuts."""
            if pending:
                n = sum(len(p) for p in pending)
                opened = owner if at_start and inside else number
                yield rows_of(joined(pending, np.array([n - 1])), [opened], [bool(header_due)])
                pending.clear()

        for batch in batches:
            numbers = batch.column(0).to_numpy()
            odd = np.asarray(batch.column(5).to_numpy(zero_copy_only=False), bool)
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
                if low == high:
                    continue
                if numbers[low] != number:
                    yield from rest()
                    number = int(numbers[low])
                    inside, owner, header_due, begin = (batch.column(i)[low].as_py() for i in (1, 2, 3, 4))
                    open_now, at_start = bool(inside), True
                after = np.logical_xor(np.cumsum(odd[low:high]) % 2 == 1, open_now)
                open_now = bool(after[-1])
                own = batch.column(6).slice(low, high - low)
                ends = np.flatnonzero(~after)
                if not len(ends):
                    pending.append(own)
                    continue
                held = sum(len(p) for p in pending)
                last = int(ends[-1]) + 1
                done = joined([*pending, own.slice(0, last)], ends + held)
                pending = [own.slice(last)] if last < len(own) else []
                yield answer(done)
        yield from rest()

    return rows.mapInArrow(work, "owner bigint, begin bigint, header boolean, record binary")


def ddl(fields: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)


def read_csv_parts(
    spark: SparkSession, path: str, schema: str | T.StructType, part_bytes: int | None = None, options: dict | None = None
) -> DataFrame:
    """Rows of CSV files with a header line, as one task for each file would read them with ``multiLine``.

    ``part_bytes`` is the size of a range; without it Spark's setting for files decides. The records are written to the shared
    folder, so the files are read twice and only here.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with fixed_ranges(spark, part_bytes):
        each = lines(spark, path, part_bytes)
        known = stage(ranges(each), "csv-ranges")
        few = known.limit(MOST_RANGES + 1).count() <= MOST_RANGES
        # A range that the first pass did not see would lose its lines: it stops the job instead.
        placed = each.join(F.broadcast(known) if few else known, RANGE, "left")
        number = F.coalesce("number", F.raise_error(F.lit("the byte ranges of the files have changed")).cast("bigint"))
        line = F.when(F.col("crlf"), F.regexp_replace("line", r"\r\z", "")).otherwise(F.col("line"))
        placed = placed if few else placed.sortWithinPartitions("path", "begin", "row")
        placed = placed.select(number.alias("number"), "inside", "owner", "first", "begin", "odd", line.cast("binary").alias("line"))
        found = stage(records(placed), "csv-records")
    whole = found.filter("owner IS NULL").select("header", "record")
    pieces = F.array_sort(F.collect_list(F.struct("begin", F.col("record").cast("string").alias("piece"))))
    crossed = found.filter("owner IS NOT NULL").groupBy("owner").agg(
        F.max("header").alias("header"), F.array_join(pieces["piece"], "\n").alias("record")
    )
    text = F.regexp_replace("record", r"\r\z", "")
    every = whole.withColumn("record", F.col("record").cast("string")).unionByName(crossed.drop("owner")).filter("NOT header").select(text.alias("record"))
    parser = {"multiLine": "true", "escape": '"', **(options or {})}
    parsed = every.filter("record <> ''").select(F.from_csv("record", ddl(fields), parser).alias("r"))
    return parsed.select("r.*")
