"""Registered queries, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import dealt, shared_folder, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """Path for files that a query writes and reads back."""
    return f"{shared_folder(spark)}/ledgerlens/{spark.sparkContext.applicationId}/{name}"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, spread over the cores because the text work per row is heavy."""
    return spread(table(spark, folder, "documents"), "doc_id")


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """Report texts, one per order, with the segment of the customer and a return."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    orders, customer = spread(orders, "o_orderkey"), table(spark, folder, "customer")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    text = F.concat(
        F.lit("We reported $"),
        F.floor(price / 1000).cast("string"),
        F.lit(".5 million in revenue and $"),
        (key % 90 + 1).cast("string"),
        F.lit(" million profit. "),
        F.when(F.col("o_orderstatus") == "F", "Results were strong and we delivered record growth of ")
        .when(
            F.col("o_orderstatus") == "O",
            "Weak demand and a decline in orders hurt results, with an increase of only ",
        )
        .otherwise("Estimates may fluctuate and remain uncertain, with growth of "),
        (key % 40).cast("string"),
        F.lit(".2% over the prior year. Earnings per share were $"),
        (key % 7).cast("string"),
        F.lit(".25 for the period. "),
        F.when(key % 3 == 0, "This forward-looking statement is covered by the safe harbor rules. ").otherwise(
            "Gross margin was 35% for the period under review. "
        ),
        F.when(key % 5 == 0, "The attorney expects arbitration and an appeal in the pending litigation. ").otherwise(
            "Thank you. "
        ),
    )
    # The texts are made after the rows are dealt, so what is shuffled is narrow. The count reads the files' footers only.
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    joined = dealt(joined, table(spark, folder, "orders").count(), "o_orderkey", "o_custkey", "o_totalprice")
    return joined.select(
        key.alias("report_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderdate").alias("report_date"),
        text.alias("ea_text"),
        F.round((price - 250000.0) / 2500000.0, 4).alias("bhar0_2"),
    )


REPORTS_SQL = """
reports AS (
  SELECT o_orderkey AS report_id, c_mktsegment AS segment, o_orderdate AS report_date,
    'We reported $' || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR)
    || '.5 million in revenue and $' || CAST(o_orderkey % 90 + 1 AS VARCHAR) || ' million profit. '
    || CASE WHEN o_orderstatus = 'F' THEN 'Results were strong and we delivered record growth of '
            WHEN o_orderstatus = 'O'
            THEN 'Weak demand and a decline in orders hurt results, with an increase of only '
            ELSE 'Estimates may fluctuate and remain uncertain, with growth of ' END
    || CAST(o_orderkey % 40 AS VARCHAR) || '.2% over the prior year. Earnings per share were $'
    || CAST(o_orderkey % 7 AS VARCHAR) || '.25 for the period. '
    || CASE WHEN o_orderkey % 3 = 0 THEN 'This forward-looking statement is covered by the safe harbor rules. '
            ELSE 'Gross margin was 35% for the period under review. ' END
    || CASE WHEN o_orderkey % 5 = 0
            THEN 'The attorney expects arbitration and an appeal in the pending litigation. '
            ELSE 'Thank you. ' END AS ea_text,
    round((o_totalprice - 250000.0) / 2500000.0, 4) AS bhar0_2
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def with_reports(body: str, *more: str) -> str:
    """SQL that starts with the reports table and further named tables."""
    return "WITH " + ",\n".join([REPORTS_SQL.strip(), *[m.strip() for m in more]]) + "\n" + body.strip()


def with_tables(body: str, *more: str) -> str:
    return "WITH " + ",\n".join(m.strip() for m in more) + "\n" + body.strip()
