"""The corpus index: transcripts joined with metadata, summaries, cue files and
channel settings; candidate windows; coverage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapsed_word_count, normalize_markdown, word_count
from .matching import left_join_known, match_by_id_then_stem


def summary_stats(summaries: DataFrame, text: str) -> DataFrame:
    """Words and characters of the normalized text; null where it is empty."""
    clean = normalize_markdown(F.col(text))
    rows = summaries.withColumn("normalized", F.nullif(clean, F.lit("")))
    return rows.withColumns(
        {
            "summary_words": collapsed_word_count("normalized"),
            "summary_chars": F.length("normalized").cast("long"),
        }
    )


def build_index(
    transcripts: DataFrame, metadata: DataFrame, summaries: DataFrame, cue_ends: DataFrame, channels: DataFrame
) -> DataFrame:
    """One row per transcript path.

    transcripts: path, channel, video_id?, stem, text; metadata: channel,
    video_id, stem, path, title, upload_date; summaries: channel, video_id,
    stem, path, text; cue_ends: path, last_end_ms (null without entries); channels:
    channel, language, category, description.  The cue file of a transcript has its path
    with ``.srt`` for the suffix.  ``problem`` names a failed required join.
    """
    keys = ["channel", "video_id"]
    base = transcripts.withColumn("word_count", word_count("text")).drop("text")
    with_meta = match_by_id_then_stem(base, metadata, keys, "stem", "path", "metadata_path")
    with_sum = match_by_id_then_stem(with_meta, summaries, keys, "stem", "path", "summary_path").drop("summary_path_status")
    meta = metadata.select(
        F.col("path").alias("metadata_path"), "title", "upload_date", F.col("video_id").alias("__meta_id")
    )
    stats = summary_stats(summaries, "text").select(F.col("path").alias("summary_path"), "summary_words", "summary_chars")
    joined = (
        left_join_known(left_join_known(with_sum, meta, "metadata_path"), stats, "summary_path")
        .withColumn("__srt", F.regexp_replace("path", r"\.[^./]+$", ".srt"))
        .join(cue_ends.select(F.col("path").alias("__srt"), "last_end_ms", F.col("path").alias("cleaned_srt")), "__srt", "left")
        .join(channels.withColumn("__known", F.lit(True)), "channel", "left")
    )
    problem = F.when(F.col("__known").isNull(), "unknown channel").when(
        F.col("metadata_path").isNull(), F.concat(F.lit("metadata "), F.col("metadata_path_status"))
    )
    has = F.col("summary_words").isNotNull()
    return joined.select(
        "path",
        "channel",
        F.coalesce("video_id", "__meta_id").alias("video_id"),
        "title",
        "upload_date",
        F.floor(F.col("last_end_ms") / 1000).cast("long").alias("duration_seconds"),
        "word_count",
        has.alias("has_summary"),
        F.struct(
            F.col("path").alias("cleaned_txt"),
            "cleaned_srt",
            F.when(has, F.col("summary_path")).alias("summary_md"),
            F.col("metadata_path").alias("metadata_json"),
        ).alias("paths"),
        F.struct("language", "category", "description").alias("channel_meta"),
        F.when(has, F.struct(F.col("summary_words").alias("word_count"), F.col("summary_chars").alias("char_count"))).alias("summary_stats"),
        problem.alias("problem"),
    )


def index_order() -> list[Column]:
    return [F.asc("channel"), F.asc_nulls_first("upload_date"), F.asc("video_id")]


def check_index(index: DataFrame) -> None:
    """Raise on a failed required join."""
    from .matching import require_none

    require_none(index.where("problem is not null").select("path", "problem"), "transcript cannot be indexed")


def candidates(
    index: DataFrame, reference: dt.date, lookback_days: int = 30, channel: str | None = None, strict: bool = True
) -> DataFrame:
    """Summarised records of the window, optionally of one channel.

    With ``strict`` a candidate without a date and an unknown channel raise;
    both checks look at one row at most.
    """
    from .matching import require_none

    rows = index.where("has_summary")
    if channel is not None:
        if strict and not index.where(F.col("channel") == channel).take(1):
            raise ValueError(f"channel {channel!r} matches no channel in the corpus")
        rows = rows.where(F.col("channel") == channel)
    if strict:
        require_none(rows.where("upload_date is null").limit(1), "record lacks an upload date")
    cutoff = reference - dt.timedelta(days=lookback_days)
    return rows.where(F.col("upload_date") >= F.lit(cutoff))


def snapshot(index: DataFrame) -> DataFrame:
    """One row: records, with summary, coverage (null without records), date range, channels."""
    return index.agg(
        F.count(F.lit(1)).alias("videos"),
        F.count_if(F.col("has_summary")).alias("with_summary"),
        F.round(F.try_divide(F.count_if(F.col("has_summary")) * 100.0, F.count(F.lit(1))), 4).alias("coverage_pct"),
        F.min("upload_date").alias("first_date"),
        F.max("upload_date").alias("last_date"),
        F.count_distinct("channel").alias("channels"),
    )


def bucket_counts(rows: DataFrame) -> DataFrame:
    """Videos and sorted channel -> count map per bucket.

    Counted in two levels, so the map is built from one row per channel.
    """
    per = rows.groupBy("bucket", "channel").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("bucket").agg(
        F.sum("n").alias("video_count"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("channel", "n")))).alias("channels"),
    )
