"""Running aggregates that never put a whole key into one task.

A plain window over a key is one task per key, which fails when one key holds a
third of the table.  Here rows are cut into blocks of ``BLOCK`` order values,
blocks into blocks of blocks, and each level adds what came before it.  A task
sees at most one block.  The order column must be an integer, unique per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
LEVELS = 2


def _aggregate(how: str, value: Column, order: Column) -> Column:
    if how == "sum":
        return F.sum(value)
    if how == "max":
        return F.max(value)
    if how == "last":
        return F.max_by(value, F.when(value.isNotNull(), order))
    raise ValueError(f"unknown fold {how!r}")


def _over(how: str, value: Column, window) -> Column:
    if how == "sum":
        return F.sum(value).over(window)
    if how == "max":
        return F.max(value).over(window)
    return F.last(value, ignorenulls=True).over(window)


def _combine(how: str, earlier: Column, later: Column) -> Column:
    if how == "sum":
        return F.coalesce(earlier, F.lit(0)) + F.coalesce(later, F.lit(0))
    if how == "max":
        return F.greatest(earlier, later)
    return F.coalesce(later, earlier)


def _carry(df: DataFrame, keys: list[str], order: str, value: str, how: str, out: str, levels: int) -> DataFrame:
    """Add ``out``: the fold of ``value`` over all earlier rows of the key."""
    if levels == 0:
        parts = [F.col(k) for k in keys] or [F.lit(0)]
        w = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, _over(how, F.col(value), w))
    block, total, before = f"__{out}_b{levels}", f"__{out}_t{levels}", f"__{out}_c{levels}"
    rows = df.withColumn(block, F.floor(F.col(order) / BLOCK).cast("long"))
    totals = rows.groupBy(*keys, block).agg(_aggregate(how, F.col(value), F.col(order)).alias(total))
    offsets = _carry(totals, keys, block, total, how, before, levels - 1).drop(total)
    w = Window.partitionBy(*keys, block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(offsets, [*keys, block])
        .withColumn(out, _combine(how, F.col(before), _over(how, F.col(value), w)))
        .drop(block, before)
    )


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: Column,
    out: str,
    how: str = "sum",
    inclusive: bool = True,
) -> DataFrame:
    """Running ``sum``, ``max`` or ``last`` (non-null) of ``value`` per key."""
    tmp, carried = f"__{out}_v", f"__{out}_p"
    rows = _carry(df.withColumn(tmp, value), keys, order, tmp, how, carried, LEVELS)
    here = _combine(how, F.col(carried), F.col(tmp)) if inclusive else F.col(carried)
    if how == "sum":
        here = F.coalesce(here, F.lit(0))
    return rows.withColumn(out, here).drop(tmp, carried)


def running_number(df: DataFrame, keys: list[str], order: str, out: str) -> DataFrame:
    """Row number from 1 per key in ``order``."""
    return running(df, keys, order, F.lit(1).cast("long"), out)
