"""Silence and speech intervals of a recording, in integer milliseconds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .running import running

MIN_PIECE_MS = 10


def pair_log_lines(lines: DataFrame, key: str, order: str, line: str = "line") -> DataFrame:
    """``silence_start`` lines paired with the next ``silence_end`` line.

    An end takes the last start before it that no other end took.
    """
    start = F.regexp_extract(line, r"silence_start: ([0-9.]+)", 1)
    end = F.regexp_extract(line, r"silence_end: ([0-9.]+) \| silence_duration: ([0-9.]+)", 1)
    marks = lines.withColumns(
        {"__s": F.nullif(start, F.lit("")).try_cast("double"), "__e": F.nullif(end, F.lit("")).try_cast("double")}
    ).where("__s is not null or __e is not null")
    # An end closes the pending start, so it is marked as a reset.
    pending = running(
        marks, [key], order, F.struct(F.col("__s").alias("s"), F.col("__e").isNotNull().alias("closed")), "__p",
        how="last", inclusive=False,
    )
    return pending.where("__e is not null and __p.s is not null and not __p.closed").select(
        key,
        F.round(F.col("__p.s") * 1000).cast("long").alias("start_ms"),
        F.round(F.col("__e") * 1000).cast("long").alias("end_ms"),
    )


def complement(silences: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """Speech pieces: what the silences leave of [0, total); pieces under
    10 ms are dropped.

    The cursor is the end of the previous silence.  The pieces are stored: the
    steps behind read them several times.
    """
    silences = materialize(silences, "silences")
    prev = running(silences, [key], "start_ms", F.col("end_ms"), "__cursor", how="last", inclusive=False)
    gaps = prev.select(key, F.coalesce("__cursor", F.lit(0)).cast("long").alias("from_ms"), F.col("start_ms").alias("to_ms"))
    last = silences.groupBy(key).agg(F.max_by("end_ms", "start_ms").alias("__last"))
    tail = totals.join(last, key, "left").select(
        key, F.coalesce("__last", F.lit(0)).cast("long").alias("from_ms"), F.col("total_ms").alias("to_ms")
    )
    return materialize(gaps.unionByName(tail).where(F.col("to_ms") - F.col("from_ms") >= MIN_PIECE_MS), "speech")


def trimmed(speech: DataFrame, key: str) -> DataFrame:
    """Positions of the kept pieces in the trimmed recording."""
    length = F.col("to_ms") - F.col("from_ms")
    return running(speech, [key], "from_ms", length, "trimmed_to").withColumn("trimmed_from", F.col("trimmed_to") - length)


def to_original(points: DataFrame, kept: DataFrame, key: str, point: str) -> DataFrame:
    """Trimmed time to original time; null outside every kept piece.  A border
    belongs to the earlier piece."""
    # Pieces tile the trimmed recording, so a point lies in the last piece that starts
    # before it.  Starts and distinct points are put in one order and filled forward;
    # a start comes behind a point at the same place, but for the first piece.
    starts = kept.select(
        key,
        F.when(F.col("trimmed_from") == 0, F.lit(0)).otherwise(F.col("trimmed_from") * 2 + 1).cast("long").alias("__at"),
        F.struct("from_ms", "trimmed_from", "trimmed_to").alias("__piece"),
    ).groupBy(key, "__at").agg(F.max("__piece").alias("__piece"))
    asked = points.where(F.col(point) >= 0).select(key, (F.col(point).cast("long") * 2).alias("__at")).distinct()
    both = starts.unionByName(asked, allowMissingColumns=True).groupBy(key, "__at").agg(F.max("__piece").alias("__piece"))
    both = materialize(both, "points-and-pieces")
    filled = running(both, [key], "__at", F.col("__piece"), "__last", how="last").select(key, "__at", "__last")
    placed = points.withColumn("__at", F.col(point).cast("long") * 2).join(filled, [key, "__at"], "left")
    inside = F.col(point) <= F.col("__last.trimmed_to")
    original = F.when(inside, F.col("__last.from_ms") + F.col(point) - F.col("__last.trimmed_from"))
    return placed.withColumn("original_ms", original).drop("__at", "__last")
