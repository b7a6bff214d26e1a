"""Top rows per group and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 32


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, spread_on: str | None = None, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each group.

    ``row_number <= n`` is pruned map-side by Spark's group limit.  With
    ``spread_on`` a first pass runs per salted part of the group, so that the
    final task of a hot group sees at most ``SALTS * n`` rows.
    """
    rows = df
    if spread_on is not None:
        salt = F.pmod(F.xxhash64(spread_on), F.lit(SALTS))
        w = Window.partitionBy(*keys, "__salt").orderBy(*order)
        rows = rows.withColumn("__salt", salt).withColumn("__rn", F.row_number().over(w))
        rows = rows.where(F.col("__rn") <= n).drop("__rn", "__salt")
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "__rn"
    rows = rows.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return rows if rank else rows.drop(name)


def ranked(df: DataFrame, order: list[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows overall with their rank from 1.

    The limit comes first, so the unpartitioned window sees at most ``n`` rows.
    """
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long"))
