"""A corpus pipeline of five stages, each stored as Parquet and read again by the next.

All stages treat odd rows alike.  Every row is judged by its own whole text, however long,
also where ids are null or repeat.  Of equal or similar rows the one of the smallest id
stays, a null id comes after all others, and of rows of one id any one stays.  Null texts
count as empty, and empty texts are clean.  All columns are kept as they are, whatever their
names; null values in them mean nothing.  An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpuslab.llm import bigru, bpe, cuckoo, near, winnow
from corpuslab.llm.common import importable, table, without_rows
from corpuslab.session import scratch_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the recurrent network does not predict to be toxic."""
    return bigru.accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the smallest id; null and empty texts are one group."""
    return without_rows(docs, lambda d: cuckoo.exact_dedup(d).where("NOT kept"))


#: Words of a shingle in the near-dedup stage; query op10 has its own two.
NEAR_WORDS = 5


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component, that of the smallest id; texts without words all stay."""
    return without_rows(docs, lambda d: near.near_duplicates(d, size=NEAR_WORDS).where("NOT kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; a null text has none."""
    items = table(spark, sf_dir, "benchmark")
    return without_rows(docs, lambda d: winnow.decontaminate(d, items).where("contaminated"))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document that is left, one row per row."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe_round_trip),
]

#: Training and tokenising have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    importable(spark)
    root = scratch_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{root}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
