"""Markdown of the themes, timeline and digest reports, as ordered lines.

Every report is a frame (``pos``, ``line``), ready for ``writers.write_lines``; ``pos`` is a
struct that sorts as the report reads.  What goes in are capped reports and counts, so a
report stays small at any size of the corpus.  A part without rows has a line that says so.
Every part begins with its empty line, so no report ends with one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus

# Headings, labels and placeholders of the report format.
TERMS_HEAD = ["| Rank | Term | Score | Videos |", "|------|------|-------|--------|"]
PHRASES_HEAD = ["| Rank | Phrase | Doc frequency | Top channels |", "|------|--------|---------------|--------------|"]
NO_TERMS = "_No terms extracted._"
NO_PHRASES = "_No phrases met the document-frequency threshold._"
NO_VIDEOS = "_No videos in the lookback window._"
FIRST_RUN = "_First run — no previous snapshot._"
ALL_CHANNELS = "all channels"
NO_DATE = "unknown date"
NO_RANGE = "unknown"
NOTHING = "none"


def listing(items: Column) -> Column:
    return F.when(F.size(items) == 0, F.lit(NOTHING)).otherwise(F.array_join(items, ", "))


def cell(text: Column) -> Column:
    """Text inside a table cell."""
    return F.replace(text, F.lit("|"), F.lit("\\|"))


def _texts(lines: list) -> Column:
    made = [F.lit(x) if isinstance(x, str) else x for x in lines]
    return F.array(*made) if made else F.array().cast("array<string>")


def _lines(rows: DataFrame, section: int, place: Column, lines: Column) -> DataFrame:
    """The lines of every row, rows in the order of ``place`` (text that sorts)."""
    pos = F.struct(F.lit(section).alias("section"), F.col("place"), F.col("i"))
    return rows.select(place.alias("place"), F.posexplode(lines).alias("i", "line")).select(pos.alias("pos"), "line")


def _fixed(spark: SparkSession, section: int, lines: list[str]) -> DataFrame:
    return _lines(spark.range(1), section, F.lit(""), _texts(lines))


def _if_any(rows: DataFrame, section: int, some: list[str], none: list[str]) -> DataFrame:
    """One part where ``rows`` has rows, and another one where it has none."""
    return _lines(rows.agg(F.count(F.lit(1)).alias("n")), section, F.lit(""), F.when(F.col("n") > 0, _texts(some)).otherwise(_texts(none)))


def _by_rank(rank: str = "rank") -> Column:
    return F.lpad(F.col(rank).cast("string"), 9, "0")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _tables(terms: DataFrame, phrases: DataFrame, section: int, level: str) -> list[DataFrame]:
    """Tables of terms and phrases below headings of ``level``; takes four sections."""
    term_line = F.format_string("| %d | %s | %.6f | %d |", "rank", cell(F.col("term")), "score", "document_frequency")
    phrase_line = F.format_string("| %d | %s | %d | %s |", "rank", cell(F.col("term")), "document_frequency", cell(F.array_join("channels", ", ")))
    return [
        _if_any(terms, section, ["", f"{level} Top terms (TF-IDF)", "", *TERMS_HEAD], ["", f"{level} Top terms (TF-IDF)", "", NO_TERMS]),
        _lines(terms, section + 1, _by_rank(), F.array(term_line)),
        _if_any(phrases, section + 2, ["", f"{level} Top phrases", "", *PHRASES_HEAD], ["", f"{level} Top phrases", "", NO_PHRASES]),
        _lines(phrases, section + 3, _by_rank(), F.array(phrase_line)),
    ]


def _filter(channel: str | None) -> str:
    return ALL_CHANNELS if channel is None else channel


def _considered(docs: DataFrame, section: int) -> DataFrame:
    counted = docs.agg(F.count(F.lit(1)).alias("n"))
    return _lines(counted, section, F.lit(""), F.array(F.format_string("- Videos considered: %d", "n")))


def theme_lines(docs: DataFrame, terms: DataFrame, phrases: DataFrame, lookback_days: int, channel: str | None = None) -> DataFrame:
    """The themes report: window, filter, videos considered, ranked terms and phrases.

    ``docs`` are the candidates; they are only counted.
    """
    head = ["# Themes Report", "", f"- Lookback days: {lookback_days}", f"- Channel filter: {_filter(channel)}"]
    return _union([_fixed(docs.sparkSession, 0, head), _considered(docs, 1), *_tables(terms, phrases, 2, "##")])


def timeline_lines(docs: DataFrame, buckets: DataFrame, bucket: str, lookback_days: int, channel: str | None = None) -> DataFrame:
    """The timeline report, buckets in the order of their keys."""
    head = ["# Timeline Report", "", f"- Lookback days: {lookback_days}", f"- Channel filter: {_filter(channel)}", f"- Bucket type: {bucket}"]
    pairs = F.transform(F.array_sort(F.map_entries("channels")), lambda e: F.format_string("%s (%d)", e["key"], e["value"]))
    lines = F.array(
        F.lit(""), F.concat(F.lit("## "), "bucket"), F.lit(""),
        F.format_string("- Videos: %d", "video_count"),
        F.concat(F.lit("- Channels: "), F.array_join(pairs, ", ")),
        F.concat(F.lit("- Top terms: "), listing(F.col("top_terms"))),
        F.concat(F.lit("- Top phrases: "), listing(F.col("top_phrases"))),
    )
    return _union(
        [
            _fixed(docs.sparkSession, 0, head),
            _considered(docs, 1),
            _lines(buckets, 2, F.col("bucket"), lines),
            _if_any(buckets, 3, [], ["", NO_VIDEOS]),
        ]
    )


def _snapshot_lines(index: DataFrame, section: int) -> DataFrame:
    covered = F.format_number(F.coalesce("coverage_pct", F.lit(0.0)), 1)
    lines = F.array(
        F.format_string("- Videos indexed: %d", "videos"),
        F.concat(F.format_string("- With summaries: %d (", "with_summary"), covered, F.lit("%)")),
        F.concat(F.lit("- Date range: "), F.coalesce(F.concat(F.col("first_date").cast("string"), F.lit(" — "), F.col("last_date").cast("string")), F.lit(NO_RANGE))),
        F.format_string("- Channels: %d", "channels"),
    )
    return _lines(corpus.snapshot(index), section, F.lit(""), lines)


def _emerging_lines(spark: SparkSession, section: int, previous_day: str | None, new_terms: DataFrame, new_phrases: DataFrame) -> list[DataFrame]:
    head = ["", "## Emerging (vs previous run)", ""]
    if previous_day is None:
        return [_fixed(spark, section, [*head, FIRST_RUN])]

    def fresh(rows: DataFrame, place: str, label: str) -> DataFrame:
        found = rows.agg(F.array_sort(F.collect_set("term")).alias("t"))
        return _lines(found, section + 1, F.lit(place), F.array(F.concat(F.lit(f"- {label}: "), listing(F.col("t")))))

    return [
        _fixed(spark, section, [*head, f"- Previous run: {previous_day}"]),
        fresh(new_terms, "0", "New terms"),
        fresh(new_phrases, "1", "New phrases"),
    ]


def digest_lines(
    index: DataFrame,
    docs: DataFrame,
    terms: DataFrame,
    phrases: DataFrame,
    videos: DataFrame,
    buckets: DataFrame,
    new_terms: DataFrame,
    new_phrases: DataFrame,
    reference: dt.date,
    previous_day: str | None,
    bucket: str,
    lookback_days: int,
    channel: str | None = None,
) -> DataFrame:
    """The digest: snapshot of the index, themes, timeline, what is new since the run of
    ``previous_day`` (None: a first run), and a reading list of videos per phrase.

    ``videos``: term, position, title, channel, upload_date, summary_md.  ``docs`` are the
    candidates; they are only counted.
    """
    spark = index.sparkSession
    head = ["# Research Digest", "", f"Generated: {reference.isoformat()}", "", "## Corpus Snapshot", ""]
    themes = ["", f"## Top Themes (last {lookback_days} days)", "", f"- Channel filter: {_filter(channel)}"]
    bucket_lines = F.array(
        F.lit(""), F.concat(F.lit(f"### {bucket.capitalize()} "), "bucket"), F.lit(""),
        F.format_string("- Videos: %d", "video_count"),
        F.concat(F.lit("- Top terms: "), listing(F.col("top_terms"))),
    )
    dated = F.coalesce(F.col("upload_date").cast("string"), F.lit(NO_DATE))
    read = F.format_string("%d. **%s** — %s, %s — `%s`", "position", "title", "channel", dated, "summary_md")
    reading = videos.join(F.broadcast(phrases.select("term", "rank")), "term")
    headed = phrases.select("rank", F.lit(0).alias("position"), F.array(F.lit(""), F.concat(F.lit("### "), "term"), F.lit("")).alias("lines"))
    listed = reading.select("rank", F.col("position").cast("int").alias("position"), F.array(read).alias("lines"))
    entries = headed.unionByName(listed)
    return _union(
        [
            _fixed(spark, 0, head),
            _snapshot_lines(index, 1),
            _fixed(spark, 2, themes),
            _considered(docs, 3),
            *_tables(terms, phrases, 4, "###"),
            _fixed(spark, 8, ["", "## Timeline"]),
            _lines(buckets, 9, F.col("bucket"), bucket_lines),
            _if_any(buckets, 10, [], ["", NO_VIDEOS]),
            *_emerging_lines(spark, 11, previous_day, new_terms, new_phrases),
            _fixed(spark, 13, ["", "## Reading List"]),
            _lines(entries, 14, F.concat(_by_rank(), F.lit("."), _by_rank("position")), F.col("lines")),
            _if_any(phrases, 15, [], ["", NO_PHRASES]),
        ]
    )
