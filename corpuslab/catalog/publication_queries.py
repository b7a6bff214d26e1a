"""Queries over publication records (events)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import publications as P
from ..plans import views
from ..session import scratch_dir
from ..sources import files, writers
from .base import query
from .sqltext import PUBS, with_

_RATES = """round(n / span, 9) AS per_day, round(n / span * 7.0, 9) AS per_week, round(n / span * 30.436875, 9) AS per_month"""
_AGG = """count(*) AS n, CAST(min(published_at) AS DATE) AS d0, CAST(max(published_at) AS DATE) AS d1,
  date_diff('day', CAST(min(published_at) AS DATE), CAST(max(published_at) AS DATE)) + 1 AS span"""


def _flat(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "channel", *extra, "video_count",
        F.to_date("first_published").cast("string").alias("first_day"),
        F.to_date("last_published").cast("string").alias("last_day"),
        "span_days",
        *[F.round(c, 9).alias(c) for c in ("per_day", "per_week", "per_month")],
    )


@query(
    "publication_frequency",
    with_(PUBS) + f"""SELECT channel, channel_id, n AS video_count, CAST(d0 AS VARCHAR) AS first_day, CAST(d1 AS VARCHAR) AS last_day,
  span AS span_days, {_RATES}
  FROM (SELECT channel, arg_max(channel_id, published_at) AS channel_id, {_AGG} FROM pubs GROUP BY channel) ORDER BY n / span DESC, channel""",
)
def publication_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(P.by_rate(P.channel_frequencies(views.publications(spark, sf_dir))), "channel_id")


@query(
    "publication_report",
    with_(PUBS) + f"""SELECT coalesce(channel, 'TOTAL') AS channel, is_total, n AS video_count, CAST(d0 AS VARCHAR) AS first_day,
  CAST(d1 AS VARCHAR) AS last_day, span AS span_days, {_RATES}
  FROM (SELECT channel, CAST(grouping(channel) AS BIGINT) AS is_total, {_AGG} FROM pubs GROUP BY GROUPING SETS ((channel), ()))""",
)
def publication_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(P.frequency_report(views.publications(spark, sf_dir)), "is_total")


@query(
    "channel_ranking",
    with_(PUBS) + f"""SELECT channel_id, round(n / span, 9) AS per_day
  FROM (SELECT channel, max(channel_id) AS channel_id, {_AGG} FROM pubs GROUP BY channel)""",
)
def channel_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = P.least_frequent_first(P.channel_frequencies(views.publications(spark, sf_dir)))
    return ranked.withColumn("per_day", F.round("per_day", 9))


@query("channel_ranking_file", with_(PUBS) + "SELECT DISTINCT channel_id AS line FROM pubs")
def channel_ranking_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking written as text, one channel id a line, and read back."""
    path = scratch_dir(spark, "ranking")
    writers.write_ranking(channel_ranking(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _payload(pubs: DataFrame) -> DataFrame:
    """Metadata JSON per event; event types carry different faults."""
    e = F.col("event_id")
    stamp = F.unix_seconds(F.col("published_at").cast("timestamp")).cast("string")
    ts = F.when(e % 29 == 1, F.lit("true")).when(e % 29 == 2, F.concat(F.lit('"'), stamp, F.lit('"'))).otherwise(stamp)
    seconds = F.col("duration_s").cast("string")
    dur = F.when(e % 29 == 3, F.concat(F.lit("-"), seconds)).when(e % 29 == 4, F.lit("null")).otherwise(seconds)
    title = F.when(e % 29 == 5, F.lit("")).otherwise(F.col("title"))
    body = F.concat(
        F.lit('{"timestamp": '), ts, F.lit(', "duration": '), dur, F.lit(', "title": "'), title,
        F.lit('", "channel_id": "'), F.col("channel_id"), F.lit('", "id": "'), F.col("video_id"), F.lit('"}'),
    )
    broken = F.when(e % 29 == 6, F.substring(body, F.lit(1), F.length(body) - 1)).when(e % 29 == 7, F.lit("[1, 2]"))
    return pubs.select("event_id", F.coalesce(broken, body).alias("payload"))


@query(
    "publication_metadata",
    with_(PUBS) + """SELECT event_id,
  CASE WHEN r IS NULL THEN strftime(date_trunc('second', published_at), '%Y-%m-%d %H:%M:%S') END AS published_at,
  CASE WHEN r IS NULL THEN CAST(ceil(duration_s / 60) AS BIGINT) END AS duration_minutes,
  CASE WHEN r IS NULL THEN title END AS title, CASE WHEN r IS NULL THEN video_id END AS video_id, r AS reason
  FROM (SELECT *, CASE event_id % 29 WHEN 1 THEN 'timestamp' WHEN 2 THEN 'timestamp' WHEN 3 THEN 'negative duration'
    WHEN 4 THEN 'duration' WHEN 5 THEN 'title' WHEN 6 THEN 'invalid JSON' WHEN 7 THEN 'not an object' END AS r FROM pubs)""",
)
def publication_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = P.parse_metadata(_payload(views.publications(spark, sf_dir)))
    return parsed.select(
        "event_id",
        F.date_format(F.to_utc_timestamp("published_at", F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("published_at"),
        "duration_minutes", "title", "video_id", "reason",
    )


def _quoted_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication rows with titles that need CSV quoting."""
    e = F.col("event_id")
    title = (
        F.when(e % 3 == 0, F.concat(F.col("title"), F.lit(', "part"')))
        .when(e % 3 == 1, F.concat(F.col("title"), F.lit("\nline")))
        .otherwise(F.col("title"))
    )
    minutes = F.ceil(F.col("duration_s") / 60).cast("long")
    return views.publications(spark, sf_dir).withColumns({"title": title, "duration_minutes": minutes})


@query(
    "timeseries_csv",
    with_(PUBS) + """SELECT CASE WHEN user_id % 2 = 0 THEN channel ELSE channel_id END AS channel, channel_id,
  strftime(published_at, '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN microsecond(published_at) % 1000000 = 0 THEN '' ELSE strftime(published_at, '.%f') END || '+00:00' AS published_at,
  CASE event_id % 3 WHEN 0 THEN title || ', "part"' WHEN 1 THEN title || chr(10) || 'line' ELSE title END AS title,
  CAST(ceil(duration_s / 60) AS BIGINT) AS duration_minutes, video_id FROM pubs""",
)
def timeseries_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the CSV, read it back, label the channels that have a name."""
    pubs = _quoted_titles(spark, sf_dir)
    path = scratch_dir(spark, "timeseries")
    writers.write_timeseries(pubs, path)
    names = views.publications(spark, sf_dir).where("user_id % 2 = 0").select("channel_id", "channel").distinct()
    return files.timeseries_csv(spark, path, names)


@query(
    "channel_id_map",
    with_(PUBS) + """SELECT title AS channel, arg_min(channel_id, video_id) AS channel_id FROM pubs
  WHERE event_id % 4 <> 0 GROUP BY title""",
)
def channel_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders are event types; every fourth file is unreadable."""
    pubs = views.publications(spark, sf_dir)
    readable = F.when(F.col("event_id") % 4 != 0, F.col("channel_id"))
    meta = pubs.select(F.col("title").alias("channel"), F.col("video_id").alias("path"), readable.alias("channel_id"))
    return P.channel_id_map(meta)


_REUSE = """cur AS (SELECT channel, count(*) AS n_files FROM pubs GROUP BY channel),
old AS (SELECT * FROM pubs WHERE published_at < TIMESTAMP '2024-01-29'),
rec AS (SELECT channel, count(*) AS n_files FROM old GROUP BY channel),
dec AS (SELECT c.channel, c.n_files, coalesce(c.n_files = r.n_files, false) AS reused FROM cur c LEFT JOIN rec r USING (channel))"""


def _reuse(spark: SparkSession, sf_dir: str):
    pubs = views.publications(spark, sf_dir).select("channel", "video_id", "published_at")
    stored = pubs.where(F.col("published_at") < F.lit("2024-01-29").cast("timestamp_ntz"))
    counts = pubs.groupBy("channel").agg(F.count(F.lit(1)).alias("n_files"))
    recorded = stored.groupBy("channel").agg(F.count(F.lit(1)).alias("n_files"))
    return P.incremental_records(pubs, stored, counts, recorded)


@query(
    "incremental_records",
    with_(PUBS, _REUSE) + """SELECT p.channel, p.video_id, CASE WHEN d.reused THEN 'reused' ELSE 'rescanned' END AS origin
  FROM pubs p JOIN dec d USING (channel)""",
)
def incremental_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = _reuse(spark, sf_dir)
    return records.select("channel", "video_id", "origin")


@query("incremental_channels", with_(PUBS, _REUSE) + "SELECT channel, n_files, reused FROM dec")
def incremental_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, decided = _reuse(spark, sf_dir)
    return decided
