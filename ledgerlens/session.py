"""Session defaults and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# At most this many rows are fetched to the driver to be broadcast; anything larger is joined by shuffle.
SMALL_TABLE_ROWS = 10_000
# At most about this many rows of costly text work go to one task.
TASK_ROWS = 50_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine. On a cluster, pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerlens")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for staged tables: the one the cluster names, or a new local one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="ledgerlens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, name: str = "stage", rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table cuts the lineage, so that later passes neither repeat the work before it nor depend on the
    executors that did it. The tables of one application lie in one folder that can be removed after it ends.
    ``rows_per_file`` bounds the rows of a file, and so those of a task that reads it: Spark joins small files to a task, but
    counts each as 4 MB, so that a task of 128 MB has at most 32. Rows that compress well would else be millions.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ledgerlens/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Broadcast ``df`` when it has at most ``limit`` rows, which is checked; else return it for a shuffle join."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread rows over all cores when the input came in fewer partitions than there are cores.

    For costly work per row on few or unsplittable files. An input of many partitions is left as it is, so a large table
    is not shuffled. Rows go by the hash of their key, which a repeated task repeats exactly.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, key)


def dealt(df: DataFrame, rows: int, *columns: str, rows_per_task: int = TASK_ROWS) -> DataFrame:
    """Deal a table of ``rows`` rows by the hash of its columns, where one task for each core would get too many of them.

    The number of tasks grows with the table, so that the longest does not. A table that fits the cores is left as it is.
    """
    wanted = -(-rows // rows_per_task)
    return df if wanted <= df.sparkSession.sparkContext.defaultParallelism else df.repartition(wanted, *columns)


def compact(df: DataFrame, rows_per_partition: int = 50_000) -> DataFrame:
    """Fewer partitions for a small table that is read many times, as by an iterative fit.

    Each pass then starts fewer tasks. A large table keeps its partitions, and nothing is shuffled.
    """
    wanted = max(1, -(-df.count() // rows_per_partition))
    return df.coalesce(wanted) if wanted < df.rdd.getNumPartitions() else df
