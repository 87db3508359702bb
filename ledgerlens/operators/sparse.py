"""Sums over sparse vectors that are too wide for one aggregate expression but bounded by the vocabulary.

The functions made here run inside tasks. They are made by a function, so that they travel with the task and the
executors need no copy of this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CELLS = 200_000  # cells handled at once in a task, to bound its memory


def cells(df: DataFrame, vector: str) -> DataFrame:
    """Replace a sparse vector by its positions ``i`` and values ``x``."""
    opened = df.withColumn("_v", F.unwrap_udt(vector)).drop(vector)
    return opened.select("*", F.col("_v.indices").alias("i"), F.col("_v.values").alias("x")).drop("_v")


def task_helpers(max_cells: int = MAX_CELLS) -> tuple[Callable, Callable, Callable]:
    """``(pieces, row_sums, column_sums)`` for batches of sparse rows."""

    def pieces(frame):
        """Cut a batch into ``(part, row of each cell, columns, values)`` with a bounded number of cells."""
        import numpy as np

        sizes = frame["i"].map(len).to_numpy()
        ends = np.cumsum(sizes)
        start = 0
        while start < len(frame):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + max_cells, side="right")))
            part = frame.iloc[start:stop]
            rows = np.repeat(np.arange(len(part)), sizes[start:stop])
            if rows.size:
                columns = np.concatenate(part["i"].to_list()).astype(np.int64)
                values = np.concatenate(part["x"].to_list())
            else:
                columns, values = np.empty(0, np.int64), np.empty(0)
            yield part, rows, columns, values
            start = stop

    def grouped_sums(keys, matrix, size):
        """Sum the rows of ``matrix`` by ascending ``keys``."""
        import numpy as np

        result = np.zeros((size, matrix.shape[1]))
        if len(keys):
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            result[keys[starts]] = np.add.reduceat(matrix, starts, axis=0)
        return result

    def row_sums(rows, matrix, size):
        return grouped_sums(rows, matrix, size)

    def column_sums(columns, matrix, size):
        import numpy as np

        order = np.argsort(columns, kind="stable")
        return grouped_sums(columns[order], matrix[order], size)

    return pieces, row_sums, column_sums


def sum_rows(df: DataFrame, width: int) -> list:
    """Add up partial sums ``(kind, i, sums)`` of all tasks; the result is bounded by kinds x positions."""
    totals = df.groupBy("kind", "i").agg(*[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)])
    return totals.collect()


def summed_parts(df: DataFrame, run: Callable, part_numbers: int = 100_000, fetch: bool = False) -> dict:
    """Add up arrays by name over all tasks: ``run`` takes a task's Arrow batches and gives ``(name, array)``.

    Names are small integers, and an array has the size of a model. A task sends its arrays in parts of ``part_numbers``; parts
    are added one after another in the order of the tasks, so a sum takes the memory of one part, and comes out the same each
    time. What is fetched is one array for each name; with ``fetch``, for small arrays of few tasks, it is the arrays of all tasks,
    which are added here in the same order.
    """
    import numpy as np

    def send(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for name, array in run(batches):
            starts = range(0, len(array), part_numbers)
            columns = [[name] * len(starts), list(starts), [task] * len(starts), [array[s : s + part_numbers].tobytes() for s in starts]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["name", "start", "task", "sums"])

    def add(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def row(key, total):
            columns = [[key[0]], [key[1]], [total.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.binary()])], ["name", "start", "sums"])

        key, total = None, None
        for batch in batches:
            for name, start, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                own = np.frombuffer(sums.as_buffer(), float)
                if (name, start) == key:
                    total = total + own
                else:
                    if key:
                        yield row(key, total)
                    key, total = (name, start), own
        if key:
            yield row(key, total)

    parts = df.mapInArrow(send, "name long, start long, task long, sums binary")
    if fetch:
        sums: dict = {}
        for name, start, _, own in sorted(parts.collect(), key=lambda r: r[:3]):
            part = np.frombuffer(own, float)
            sums[name, start] = sums[name, start] + part if (name, start) in sums else part
        joined: dict = {}
        for (name, _), part in sums.items():
            joined.setdefault(name, []).append(part)
        return {name: np.concatenate(arrays) for name, arrays in joined.items()}
    dealt = parts.repartition("name", "start").sortWithinPartitions("name", "start", "task")
    found: dict = {}
    for r in sorted(dealt.mapInArrow(add, "name long, start long, sums binary").collect()):
        found.setdefault(r["name"], []).append(np.frombuffer(r["sums"], float))
    return {name: np.concatenate(arrays) for name, arrays in found.items()}
