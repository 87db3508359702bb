"""A pipeline from raw documents to packed training sequences, each stage one operator of ``ledgerlens.llm``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import exact_dedup, minhash_join, mixing, packing, toxicity
from ledgerlens.llm.registered import tokenizer_file
from ledgerlens.session import shared_folder


MOST_REPEATS = 2.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels beside the documents."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more the one with the smallest doc_id stays."""
    return minhash_join.keep_one(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The flattest temperature mixture that repeats no source more than ``MOST_REPEATS`` times and leaves out no document.

    Documents of smaller sources appear in up to two rows, one for each pass.
    """
    return mixing.mixed_rows(docs, most_repeats=MOST_REPEATS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every row and their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

# Learned scores, signatures and packing have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, each written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/ledgerlens/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for number, (_, step) in enumerate(STAGES):
        path = f"{folder}/{number}"
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
