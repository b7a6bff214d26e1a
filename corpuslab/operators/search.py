"""Keyword search over line-split texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import running_number


def lines_of(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per line: ``line_no`` from 1 and ``line``."""
    return docs.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("__p", "line")).select(
        *keys, (F.col("__p") + 1).cast("long").alias("line_no"), "line"
    )


def line_hits(docs: DataFrame, keys: list[str], text: str, match: Column) -> DataFrame:
    """Lines for which ``match`` (an expression over ``line``) holds."""
    return lines_of(docs, keys, text).where(match)


def regex_ranking(docs: DataFrame, keys: list[str], text: str, pattern: str) -> DataFrame:
    """Documents by number of matching lines; case-sensitive regex."""
    hits = line_hits(docs, keys, text, F.col("line").rlike(pattern))
    return hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines")).orderBy(F.desc("n_lines"), *keys)


def keyword_list(keywords: str) -> list[str]:
    """Comma list to trimmed, non-empty, lower-case literals."""
    found = [k.strip().lower() for k in keywords.split(",")]
    found = [k for k in found if k]
    if not found:
        raise ValueError("no keywords provided")
    return found


def research(corpora: dict[str, DataFrame], keys: list[str], text: str, keywords: str) -> DataFrame:
    """Lines holding any of the literals, case-insensitive, counted per
    document and corpus."""
    wanted = keyword_list(keywords)
    hit = F.lit(False)
    for k in wanted:
        hit = hit | F.contains(F.lower(F.col("line")), F.lit(k))
    out = None
    for name, docs in corpora.items():
        found = line_hits(docs, keys, text, hit).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines"))
        found = found.withColumn("corpus", F.lit(name))
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise ValueError("no corpus given")
    return out.select("corpus", *keys, "n_lines")


def research_ranks(found: DataFrame, key: str) -> DataFrame:
    """Add ``rank`` within the corpus: most lines first, then by the integer ``key``.

    The documents of one count are numbered in blocks, behind the number of documents
    with higher counts, so no task sorts a corpus.
    """
    sizes = found.groupBy("corpus", "n_lines").agg(F.count(F.lit(1)).alias("__n"))
    above = Window.partitionBy("corpus").orderBy(F.desc("n_lines")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("corpus", "n_lines", F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__before"))
    placed = running_number(found, ["corpus", "n_lines"], key, "__i")
    return placed.join(offsets, ["corpus", "n_lines"]).withColumn("rank", F.col("__before") + F.col("__i")).drop("__before", "__i")


def research_counts(ranking: DataFrame, corpora: list[str]) -> DataFrame:
    """Matching documents per corpus, zero included."""
    names = ranking.sparkSession.createDataFrame([(c,) for c in corpora], "corpus string")
    return names.join(ranking, "corpus", "left").groupBy("corpus").agg(F.count("n_lines").alias("n_documents"))
