"""Work of a task stays bounded when a table grows: rows dealt to tasks, rows of a file, CSV ranges that share tasks."""

from pyspark.sql import functions as F

from ledgerlens.session import dealt, stage
from ledgerlens.sources import csv_parts, tables


def test_rows_are_dealt_by_their_number(spark):
    df = spark.range(0, 3000, 1, 2).withColumn("k", F.when(F.col("id") % 2 == 0, F.col("id")))
    cores = spark.sparkContext.defaultParallelism
    assert dealt(df, 3000, "id", rows_per_task=3000 // cores + 1).rdd.getNumPartitions() == 2
    many = dealt(df, 3000, "k", "id", rows_per_task=100)
    assert many.rdd.getNumPartitions() == 30
    sizes = [r["count"] for r in many.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 200
    assert sorted(map(tuple, many.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_files_of_bounded_rows(spark):
    df = stage(spark.range(0, 1000, 1, 1), "bounded", 100)
    assert len(df.inputFiles()) == 10 and df.count() == 1000


def test_csv_ranges_share_tasks(spark, tmp_path):
    rows = [(i, f'line "{i}"\n{"x" * (i % 50)},\n') for i in range(4000)]
    spark.createDataFrame(rows, "id int, t string").coalesce(1).write.options(**tables.CSV_OPTIONS).csv(str(tmp_path / "c"))
    with csv_parts.fixed_ranges(spark, 512):
        found = csv_parts.lines(spark, str(tmp_path / "c"), 512)
        assert found.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
        assert found.select("path", "begin").distinct().count() > 100
    read = csv_parts.read_csv_parts(spark, str(tmp_path / "c"), "id int, t string", 512)
    assert sorted(map(tuple, read.collect())) == rows
