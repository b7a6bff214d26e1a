"""Array column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hold(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A later filter on a plain computed column is pushed below it with the
    expression copied in, and inside a lambda the copy runs once per element.
    A generator in between keeps the optimizer from doing that.
    """
    keep = [c for c in df.columns if c not in columns]
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    out = df.select(*keep, packed.alias("__held"))
    return out.select(*keep, *[F.col("__held")[n].alias(n) for n in columns])


def run_starts(sorted_items: Column) -> Column:
    """Positions where a new value begins in a sorted array; null if empty."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(sorted_items) - 1),
        lambda i: (i == 0) | (sorted_items[i] != F.get(sorted_items, i - 1)),
    )
    return F.when(F.size(sorted_items) > 0, starts)


def counted(sorted_items: Column, starts: Column, item: str, count: str) -> Column:
    """array<struct<item, count>> from a sorted array and its run starts."""
    return F.transform(
        starts,
        lambda a, i: F.struct(
            sorted_items[a].alias(item),
            (F.coalesce(F.get(starts, i + 1), F.size(sorted_items)) - a).cast("long").alias(count),
        ),
    )
