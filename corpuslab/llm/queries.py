"""Queries of this package over the given tables, with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchors, bigru, bpe, brown, chat, cuckoo, licenses, near, negatives, rules, tokens, trie, winnow
from .common import importable, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op1_bpe_encode_decode")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query(
    "op6_exact_dedup",
    r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return cuckoo.exact_dedup(table(spark, sf_dir, "documents"))


@query("op2_license_scan", licenses.sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op5_benchmark_decontamination", winnow.sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    return winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op8_chat_formatting",
    r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'), '(<)(\||/?s>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g') AS escaped FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts hold control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], turns.schema)
    return chat.chat_digests(turns.unionByName(extra))


@query("op9_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class n-gram and unigram log-probability of every document."""
    return brown.score_documents(table(spark, sf_dir, "documents"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the rule ensemble."""
    return rules.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the recurrent network."""
    return bigru.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_minhash_near_dedup", near.sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near.near_duplicates(table(spark, sf_dir, "documents"), size=2)


@query("op12_simhash_near_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash component of every document."""
    return anchors.simhash_duplicates(table(spark, sf_dir, "documents"))


@query("op13_hard_negatives", negatives.sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh label is wrong by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


@query("op11_prefix_trie", trie.sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the conversations, which begin like the first one of their hundred."""
    return trie.forked_trie(table(spark, sf_dir, "conversations"))
