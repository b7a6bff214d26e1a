"""Interval joins bound to an equality key.

Both sides are spread over fixed-width buckets of the position, so a hot key is
split by position and a pair is only formed inside one bucket.  A pair that
meets in several buckets is kept in the bucket of its first common position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 1024


def _spread(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    first = F.floor(F.col(start) / width)
    last = F.floor((F.col(end) - 1) / width)
    return df.where(F.col(end) > F.col(start)).withColumn("__bucket", F.explode(F.sequence(first, last)))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width: int = WIDTH,
) -> DataFrame:
    """Inner join of half-open integer spans that overlap, keys being equal.

    Column names of the two sides must differ apart from the keys.
    """
    ls, le = left_span
    rs, re_ = right_span
    pairs = _spread(left, ls, le, width).join(_spread(right, rs, re_, width), [*keys, "__bucket"])
    first_common = F.floor(F.greatest(F.col(ls), F.col(rs)) / width)
    return pairs.where(
        (F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le)) & (F.col("__bucket") == first_common)
    ).drop("__bucket")


def point_join(
    points: DataFrame, spans: DataFrame, keys: list[str], point: str, span: tuple[str, str], width: int = WIDTH
) -> DataFrame:
    """Each point with the span that holds it (start <= p < end); left join."""
    s, e = span
    placed = points.withColumn("__bucket", F.floor(F.col(point) / width))
    spread = _spread(spans, s, e, width)
    inside = (F.col(s) <= F.col(point)) & (F.col(point) < F.col(e))
    on = [placed[k] == spread[k] for k in keys] + [placed["__bucket"] == spread["__bucket"]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = placed.join(spread, cond & inside, "left")
    for k in keys:
        joined = joined.drop(spread[k])
    return joined.drop(placed["__bucket"]).drop(spread["__bucket"])
