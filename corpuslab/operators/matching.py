"""Key matching: unique candidates, tie-breaks, fallbacks, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_by_id_then_stem(
    left: DataFrame, candidates: DataFrame, keys: list[str], stem: str, path: str, out: str
) -> DataFrame:
    """Pair each left row with at most one candidate of the same key.

    One candidate for the key is taken as it is; among several the one with the
    same stem, if that is unique; else null.  Rows without an id match on the
    stem alone.  ``keys`` ends with the id column.  Candidates are reduced to
    one row per key before the join, so a key with many copies on both sides
    never forms all pairs.  Adds ``out`` and ``out``_status.
    """
    *scope, ident = keys
    known = candidates.where(F.col(ident).isNotNull())
    by_id = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n_id"), F.min(path).alias("__p_id"))
    by_stem_id = known.groupBy(*keys, stem).agg(F.count(F.lit(1)).alias("__n_st"), F.min(path).alias("__p_st"))
    by_stem = candidates.groupBy(*scope, F.col(stem).alias("__stem")).agg(F.min(path).alias("__p_only"))
    columns = left.columns
    has_id = F.col(ident).isNotNull()
    rows = left_join_known(left_join_known(left, by_id, keys), by_stem_id, [*keys, stem])
    rows = left_join_known(rows.withColumn("__stem", F.when(~has_id, F.col(stem))), by_stem, [*scope, "__stem"])
    found = F.when(F.col("__n_id") == 1, F.col("__p_id")).when(F.col("__n_st") == 1, F.col("__p_st"))
    status = (
        F.when(~has_id, F.when(F.col("__p_only").isNull(), "missing").otherwise("stem_only"))
        .when(F.col("__n_id").isNull(), "missing")
        .when(F.col("__n_id") == 1, "by_id")
        .when(F.col("__n_st") == 1, "by_stem")
        .otherwise("ambiguous")
    )
    return rows.select(*columns, F.when(has_id, found).otherwise(F.col("__p_only")).alias(out), status.alias(f"{out}_status"))


def left_join_known(left: DataFrame, right: DataFrame, key: str | list[str]) -> DataFrame:
    """Left join on ``key``; rows without a key are dealt over all tasks, as they meet nothing.

    Both sides are named once, so stacked joins do not multiply the plan.
    """
    keys = [key] if isinstance(key, str) else list(key)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    dealt = left.withColumn("__deal", F.when(missing, F.monotonically_increasing_id() + 1).otherwise(F.lit(0)))
    # always 0, but not a constant: a constant would leave the join's keys and with it the dealing
    met = right.withColumn("__deal", F.pmod(F.xxhash64(*keys), F.lit(1)).cast("long"))
    return dealt.join(met, [*keys, "__deal"], "left").drop("__deal")


def duplicate_keys(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Keys shared by more than one row, with the first two holders."""
    return (
        df.groupBy(key.alias("key"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("first_name"), F.max(name).alias("last_name"))
        .where("n > 1")
    )


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work rows whose key is not among the finished ones."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def first_by_priority(df: DataFrame, key: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order``; partial aggregation keeps a
    hot key small."""
    picked = F.min(F.struct(*order, *[c for c in keep if c not in order])).alias("__m")
    return df.groupBy(*key).agg(picked).select(*key, *[F.col("__m")[c].alias(c) for c in keep])


def require_none(bad: DataFrame, message: str) -> None:
    """Raise if ``bad`` has a row; looks at one row only."""
    row = bad.take(1)
    if row:
        raise ValueError(f"{message}: {row[0]}")
