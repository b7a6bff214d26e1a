"""Queries over file inventories, model scores, articles and hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import frontmatter as FM
from ..functions import text as T
from ..functions.urls import with_timestamp
from ..operators import articles as A
from ..operators import cues as Q
from ..operators import evaluation as E
from ..operators import hierarchy as H
from ..operators import inventory as I
from ..operators import matching as M
from ..plans import views
from ..session import materialize, scratch_dir
from ..sources import files as files_source
from ..sources import writers
from .base import query, quoted
from .cue_queries import CUES
from .sqltext import CHANNELS, lit, strip, with_

# --- file inventory -----------------------------------------------------------


def _inventory_sql() -> str:
    ident = "lpad('id' || doc_id, 11, 'x')"
    parts = []
    for stage, ext, div, rem in views.STAGE_FILES:
        size = "n_chars * 1000" if ext == "mp4" else "n_chars"
        if stage == "transcripts":
            size = "CASE WHEN doc_id % 19 = 4 THEN 0 WHEN doc_id % 29 = 4 THEN 60 ELSE n_chars END"
        base = f"SELECT doc_id, '{stage}' AS stage, source AS channel, %s AS name, {size} AS size FROM documents WHERE doc_id % {div} <> {rem} AND "
        parts.append(base.replace("%s", f"'Doc ' || doc_id || ' [' || {ident} || '].{ext}'") + "doc_id % 23 <> 22")
        parts.append(base.replace("%s", f"'Doc ' || doc_id || '.{ext}'") + "(doc_id % 9 = 1 OR doc_id % 23 = 22)")
    parts.append(f"SELECT doc_id, 'videos', source, 'Doc ' || doc_id || ' [' || {ident} || '].f251-11.webm', n_chars FROM documents WHERE doc_id % 13 = 0")
    parts.append(f"SELECT doc_id, 'videos', source, '._Doc ' || doc_id || ' [' || {ident} || '].mp4', 4 FROM documents WHERE doc_id % 31 = 0")
    return "fl0 AS (" + "\n  UNION ALL ".join(parts) + f"""),
fl AS (SELECT *, '' AS dir, 1700000000 + doc_id * 60 AS mtime, stage || '/' || channel || '/' || name AS path,
  regexp_extract(name, '\\.([^./]+)$', 1) AS ext, nullif(regexp_extract(name, {lit(T.BRACKET_ID)}, 1), '') AS vid,
  regexp_replace(name, {lit(T.BRACKET_ID_STRIP)}, '\\1') AS plain FROM fl0),
vis AS (SELECT * FROM fl WHERE NOT starts_with(name, '._'))"""


_FILES = _inventory_sql()
_STAGES = ", ".join(
    f"count(*) FILTER (stage = '{st}' AND ext IN ({quoted(kinds)})) AS {out}" for out, (st, kinds) in I.STAGE_KINDS.items()
)
_COUNTS = f"""cn AS (SELECT channel, {_STAGES},
  CAST(coalesce(sum(size) FILTER (stage IN ('videos', 'archive') AND ext IN ({quoted(I.VIDEO_SUFFIXES)})), 0) AS BIGINT) AS total_size_bytes FROM vis GROUP BY 1)"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.file_inventory(spark, sf_dir)


@query("stage_counts", with_(_FILES, _COUNTS) + "SELECT * FROM cn")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.stage_counts(_files(spark, sf_dir))


_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in I.STAGE_KINDS)


@query(
    "completion",
    with_(_FILES, _COUNTS, f"""ct AS (SELECT coalesce(channel, 'TOTAL') AS channel, CAST(grouping(channel) AS BIGINT) AS is_total, {_SUMS},
  CAST(sum(transcripts + greatest(videos_active, audio)) AS BIGINT) AS work_units, CAST(sum(total_size_bytes) AS BIGINT) AS total_size_bytes
  FROM cn GROUP BY GROUPING SETS ((channel), ()))""")
    + """SELECT *, round(coalesce(summaries * 100.0::DOUBLE / nullif(work_units, 0), 0), 6) AS completion_pct,
  round(coalesce(hall_analysis * 100.0::DOUBLE / nullif(transcripts, 0), 0), 6) AS hall_pct,
  round(coalesce(cleaned_transcripts * 100.0::DOUBLE / nullif(transcripts, 0), 0), 6) AS cleaned_pct,
  round(coalesce(summaries * 100.0::DOUBLE / nullif(transcripts, 0), 0), 6) AS summaries_pct FROM ct""",
)
def completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = I.completion(I.stage_counts(_files(spark, sf_dir)))
    return out.withColumns({c: F.round(c, 6) for c in ("completion_pct", "hall_pct", "cleaned_pct", "summaries_pct")})


@query(
    "mismatched_channels",
    with_(_FILES, _COUNTS) + """SELECT channel, transcripts, hall_analysis, cleaned_transcripts, summaries FROM cn
  WHERE NOT (transcripts = hall_analysis AND transcripts = cleaned_transcripts AND transcripts = summaries)""",
)
def mismatched_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = I.mismatched(I.stage_counts(_files(spark, sf_dir)))
    return out.select("channel", "transcripts", "hall_analysis", "cleaned_transcripts", "summaries")


_OLD = _COUNTS.replace("cn AS", "oc AS").replace("FROM vis GROUP", "FROM vis WHERE mtime < 1700024000 AND channel <> 'src3' GROUP")


@query(
    "count_deltas",
    with_(_FILES, _COUNTS, _OLD) + """SELECT coalesce(c.channel, o.channel) AS channel, coalesce(c.transcripts, 0) AS transcripts, coalesce(c.audio, 0) AS audio,
  CASE WHEN o.channel IS NOT NULL THEN greatest(-99, least(99, coalesce(c.transcripts, 0) - o.transcripts)) END AS transcripts_delta,
  CASE WHEN o.channel IS NOT NULL THEN greatest(-99, least(99, coalesce(c.audio, 0) - o.audio)) END AS audio_delta
  FROM cn c FULL JOIN oc o ON o.channel = c.channel""",
)
def count_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a stored run that saw fewer files and lacks one channel."""
    now = I.stage_counts(_files(spark, sf_dir))
    before = I.stage_counts(_files(spark, sf_dir).where("mtime < 1700024000 and channel <> 'src3'"))
    return I.deltas(now, materialize(before, "previous-counts"), ["transcripts", "audio"])


@query(
    "privacy_labels",
    with_(_FILES, _COUNTS, CHANNELS) + """SELECT c.channel, coalesce(upper(category), 'UNKNOWN') AS label, transcripts FROM cn c
  LEFT JOIN (SELECT * FROM channel_dim WHERE category <> 'asia') d USING (channel)""",
)
def privacy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = views.channel_dim(spark, sf_dir).where("category <> 'asia'")
    return I.labelled(I.stage_counts(_files(spark, sf_dir)), dim).select("channel", "label", "transcripts")


@query(
    "id_plain_pairs",
    with_(_FILES) + """SELECT v.stage, v.channel, v.vid AS video_id, v.name AS file_with_id, v.plain AS file_without_id FROM vis v
  WHERE v.vid IS NOT NULL AND EXISTS (SELECT 1 FROM vis p WHERE p.stage = v.stage AND p.channel = v.channel AND p.name = v.plain)""",
)
def id_plain_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.id_and_plain_pairs(_files(spark, sf_dir)).drop("dir")


_ORPHANS = """orp AS (SELECT * FROM fl f WHERE NOT starts_with(name, '.') AND vid IS NULL AND NOT EXISTS
  (SELECT 1 FROM fl g WHERE NOT starts_with(g.name, '.') AND g.vid IS NOT NULL AND g.stage = f.stage AND g.channel = f.channel AND g.plain = f.name))"""


@query("orphans", with_(_FILES, _ORPHANS) + "SELECT path FROM orp")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.orphans(_files(spark, sf_dir)).select("path")


@query("orphan_totals", with_(_FILES, _ORPHANS) + "SELECT coalesce(stage, 'TOTAL') AS stage, count(*) AS n FROM orp GROUP BY GROUPING SETS ((stage), ())")
def orphan_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.orphan_totals(I.orphans(_files(spark, sf_dir)))


@query("orphan_titles", with_(_FILES, _ORPHANS) + "SELECT DISTINCT channel, regexp_replace(name, '\\.[^./]+$', '') AS title FROM orp")
def orphan_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.orphan_titles(I.orphans(_files(spark, sf_dir)))


_FILTER = """fe AS (SELECT CASE d.doc_id % 3 WHEN 0 THEN 'videos' WHEN 1 THEN 'audio' ELSE 'transcripts' END AS stage, source AS channel,
  lpad('id' || d.doc_id, 11, 'x') AS vid FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AND d.doc_id % 7 <> 3)"""


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.parse_filter(views.filter_entries(spark, sf_dir))


@query("filter_list", with_(_FILTER) + "SELECT stage, channel, vid AS video_id FROM fe")
def filter_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir)


@query(
    "unfiltered_files",
    with_(_FILES, _FILTER) + "SELECT path FROM fl f WHERE NOT EXISTS (SELECT 1 FROM fe WHERE fe.stage = f.stage AND fe.channel = f.channel AND fe.vid = f.vid)",
)
def unfiltered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.skip_filtered(_files(spark, sf_dir), _listed(spark, sf_dir)).select("path")


@query("filtered_leftovers", with_(_FILES, _FILTER) + "SELECT path FROM fl WHERE NOT starts_with(name, '.') AND vid IN (SELECT vid FROM fe)")
def filtered_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.filtered_leftovers(_files(spark, sf_dir), _listed(spark, sf_dir)).select("path")


_TARGETS = """so AS (SELECT * FROM (VALUES ('videos', 0), ('audio', 1), ('transcripts', 2)) t(stage, i)),
tg AS (SELECT f.stage, f.channel, fe.vid, f.name, f.size FROM fe JOIN so a ON a.stage = fe.stage JOIN so b ON b.i <= a.i
  JOIN fl f ON f.stage = b.stage AND f.channel = fe.channel AND contains(f.name, '[' || fe.vid || ']'))"""


@query("filter_targets", with_(_FILES, _FILTER, _TARGETS) + "SELECT stage, channel, vid AS video_id, name FROM tg")
def filter_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.filter_targets(_files(spark, sf_dir), _listed(spark, sf_dir)).select("stage", "channel", "video_id", "name")


@query("filter_target_bytes", with_(_FILES, _FILTER, _TARGETS) + "SELECT channel, vid AS video_id, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS bytes FROM tg GROUP BY 1, 2")
def filter_target_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.target_bytes(I.filter_targets(_files(spark, sf_dir), _listed(spark, sf_dir)))


@query(
    "merged_filter",
    with_(_FILES, _FILTER) + "SELECT stage, channel, vid AS video_id FROM fe UNION SELECT 'audio', channel, vid FROM vis WHERE stage = 'transcripts' AND size = 60 AND vid IS NOT NULL",
)
def merged_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing entries plus recordings without speech."""
    quiet = I.visible(_files(spark, sf_dir)).where("stage = 'transcripts' and size = 60").select(
        F.lit("audio").alias("stage"), "channel", T.bracket_id("name").alias("video_id")
    ).where("video_id is not null")
    return I.merge_filter(_listed(spark, sf_dir), quiet)


@query("empty_by_suffix", with_(_FILES) + "SELECT ext, count(*) AS n FROM vis WHERE size = 0 GROUP BY 1")
def empty_by_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.empty_by_suffix(_files(spark, sf_dir))


@query("small_transcripts", with_(_FILES) + "SELECT path, size FROM vis WHERE stage = 'transcripts' AND ext = 'txt' AND size <= 100")
def small_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.small_transcripts(_files(spark, sf_dir)).select("path", "size")


@query(
    "empty_groups",
    with_(_FILES, "st AS (SELECT *, regexp_replace(name, '\\.[^./]+$', '') AS stem FROM fl)")
    + "SELECT path FROM st WHERE ext IN ('srt', 'txt', 'vtt', 'tsv', 'json') AND (stage, channel, stem) IN (SELECT (stage, channel, stem) FROM st WHERE ext = 'srt' AND size = 0)",
)
def empty_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.empty_groups(_files(spark, sf_dir)).select("path")


@query("files_of_id", with_(_FILES) + "SELECT path FROM vis WHERE contains(name, 'xxxxxxxid42')")
def files_of_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.files_of(_files(spark, sf_dir), "xxxxxxxid42").select("path")


_MEDIA = """md AS (SELECT *, CASE WHEN doc_id % 7 <> 1 THEN n_dur END AS duration_s, doc_id % 10 <> 7 AS has_audio,
  regexp_extract(name, '\\[([A-Za-z0-9_-]{11})\\]', 1) AS id11 FROM (SELECT v.*, (v.doc_id * 37) % 900 AS n_dur FROM vis v))"""


def _media(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return _files(spark, sf_dir).withColumns(
        {"duration_s": F.when(d % 7 != 1, (d * 37) % 900), "has_audio": d % 10 != 7}
    )


@query(
    "short_videos",
    with_(_FILES, _MEDIA, f"vd AS (SELECT * FROM md WHERE stage = 'videos' AND id11 <> '' AND ext IN ({quoted(I.VIDEO_SUFFIXES)}))")
    + """SELECT channel, id11 AS video_id, duration_s, CASE WHEN duration_s < 60 AND NOT has_audio THEN 'short+no_audio' WHEN duration_s < 60 THEN 'short' ELSE 'no_audio' END AS reason
  FROM vd WHERE duration_s < 60 OR NOT has_audio UNION ALL
  SELECT channel, id11, duration_s, 'short_wav_orphan' FROM md m WHERE stage = 'audio' AND ext = 'wav' AND id11 <> '' AND duration_s < 60
  AND NOT EXISTS (SELECT 1 FROM vd WHERE vd.channel = m.channel AND vd.id11 = m.id11)""",
)
def short_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.short_videos(_media(spark, sf_dir), 60)


@query(
    "media_verdicts",
    with_(_FILES) + """SELECT path, v AS verdict FROM (SELECT path, CASE WHEN doc_id % 8 = 0 THEN 'unreadable' WHEN doc_id % 8 = 1 THEN 'invalid duration'
  WHEN doc_id % 900 > 60 AND size / (doc_id % 900) < 1000 THEN 'incomplete download' END AS v FROM vis WHERE stage = 'videos') WHERE v IS NOT NULL""",
)
def media_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    seconds = F.when(d % 16 == 0, F.lit("N/A")).when(d % 8 == 1, F.lit("12s")).when(d % 8 != 0, (d % 900).cast("string"))
    found = I.visible(_files(spark, sf_dir)).where("stage = 'videos'")
    return found.select("path", I.media_verdict(seconds, F.col("size")).alias("verdict")).where("verdict is not null")


@query(
    "unchecked_files",
    with_(_FILES) + """SELECT path FROM vis v WHERE stage = 'videos' AND 1700050000 - mtime >= 60 AND NOT EXISTS
  (SELECT 1 FROM vis c WHERE c.path = v.path AND c.ext = 'mp4' AND c.doc_id % 3 = 1)""",
)
def unchecked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache holds one file as it is, and others with another size."""
    found = I.visible(_files(spark, sf_dir)).where("stage = 'videos'")
    size = F.when(F.col("doc_id") % 3 == 1, F.col("size")).otherwise(F.col("size") + 1)
    cache = found.where("name like '%.mp4'").select("path", "mtime", size.alias("size"))
    return I.unchecked(found, cache, 1700050000).select("path")


@query(
    "media_stems",
    with_(_FILES, "pr AS (SELECT * FROM (VALUES ('audio', 1), ('videos', 2), ('archive', 3), ('transcripts', 4)) t(stage, p))")
    + """SELECT channel, vid AS video_id, regexp_extract(arg_min(name, (p, name)), '^(.*?\\[[A-Za-z0-9_-]+\\])', 1) AS stem
  FROM (SELECT channel, name, p, regexp_extract(name, '\\[([A-Za-z0-9_-]+)\\]', 1) AS vid FROM vis JOIN pr USING (stage)) WHERE vid <> '' GROUP BY 1, 2""",
)
def media_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.media_stems(_files(spark, sf_dir), ["audio", "videos", "archive", "transcripts"])


def _meta_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    seen = I.visible(_files(spark, sf_dir)).withColumn("video_id", F.nullif(F.regexp_extract("name", r"\[([A-Za-z0-9_-]{11})\]", 1), F.lit("")))
    media = seen.where("stage = 'videos' and video_id is not null").withColumn("stem", I.stem(F.col("name")))
    meta = seen.where("stage = 'metadata'").withColumn("stem", F.regexp_replace("name", r"\.info\.json$", ""))
    return media, meta


_META = """sn AS (SELECT *, nullif(regexp_extract(name, '\\[([A-Za-z0-9_-]{11})\\]', 1), '') AS id11 FROM vis),
me AS (SELECT channel, id11, name, regexp_replace(name, '\\.info\\.json$', '') AS stem FROM sn WHERE stage = 'metadata'),
mv AS (SELECT channel, id11, name, regexp_replace(name, '\\.[^./]+$', '') AS stem FROM sn WHERE stage = 'videos' AND id11 IS NOT NULL)"""


@query(
    "metadata_for_media",
    with_(_FILES, _META) + """SELECT channel, name, coalesce((SELECT min(name) FROM me WHERE me.channel = mv.channel AND me.stem = mv.stem),
  (SELECT min(name) FROM me WHERE me.channel = mv.channel AND me.id11 = mv.id11)) AS metadata_name FROM mv""",
)
def metadata_for_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.metadata_for_media(*_meta_files(spark, sf_dir)).select("channel", "name", "metadata_name")


@query(
    "audio_without_metadata",
    with_(_FILES) + """SELECT path FROM vis a WHERE stage = 'audio' AND vid IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM vis m WHERE m.stage = 'metadata' AND m.channel = a.channel AND regexp_replace(m.name, '\\.info\\.json$', '') = regexp_replace(a.name, '\\.wav$', ''))""",
)
def audio_without_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = I.visible(_files(spark, sf_dir))
    audio = seen.where("stage = 'audio'").where(T.bracket_id("name").isNotNull()).withColumn("stem", I.stem(F.col("name")))
    meta = seen.where("stage = 'metadata'").withColumn("stem", F.regexp_replace("name", r"\.info\.json$", ""))
    return M.pending(audio, meta, ["channel", "stem"]).select("path")


@query(
    "partial_downloads",
    with_(_FILES, "nm AS (SELECT *, regexp_extract(name, '\\[([A-Za-z0-9_-]{11})\\]', 1) AS id11 FROM vis)")
    + """SELECT id11 AS video_id, count(*) AS n_artifacts, min(channel) AS channel, min(name) AS first_artifact, string_agg(name, ';' ORDER BY name) AS artifacts,
  id11 IN (SELECT id11 FROM nm WHERE ends_with(name, '.mp4')) AS merged FROM nm WHERE id11 <> '' AND regexp_matches(name, '\\.f[0-9]') GROUP BY 1""",
)
def partial_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.partial_downloads(_files(spark, sf_dir))


@query(
    "fully_skipped_channels",
    with_(_FILES) + "SELECT DISTINCT channel FROM vis WHERE stage = 'hallucinations' AND channel NOT IN (SELECT channel FROM vis WHERE stage = 'transcripts' AND size > 9000)",
)
def fully_skipped_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = I.visible(_files(spark, sf_dir))
    return I.fully_skipped(seen.where("stage = 'hallucinations'"), seen.where("stage = 'transcripts' and size > 9000"))


@query(
    "unanalysed_transcripts",
    with_(_FILES) + """SELECT path FROM vis t WHERE stage = 'transcripts' AND ext = 'srt' AND NOT EXISTS (SELECT 1 FROM vis h WHERE h.stage = 'hallucinations'
  AND h.channel = t.channel AND regexp_replace(h.name, '\\.[^./]+$', '') = regexp_replace(t.name, '\\.[^./]+$', ''))""",
)
def unanalysed_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = I.visible(_files(spark, sf_dir)).withColumn("stem", I.stem(F.col("name")))
    todo = seen.where("stage = 'transcripts' and name like '%.srt'")
    return M.pending(todo, seen.where("stage = 'hallucinations'"), ["channel", "stem"]).select("path")


@query(
    "listed_files",
    "SELECT 'stage' || (doc_id % 3) AS stage, source AS channel, count(*) > 0 AS has_files FROM documents GROUP BY 1, 2",
)
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written by stage and channel, then listed without their content."""
    root = scratch_dir(spark, "tree")
    docs = views.table(spark, sf_dir, "documents")
    for i in range(3):
        part = docs.where(F.col("doc_id") % 3 == i).select("source", "text")
        part.write.partitionBy("source").option("maxRecordsPerFile", writers.FILE_TEXTS).text(f"{root}/stage{i}")
    found = files_source.inventory(spark, root).where("size > 0 and name like 'part-%'")
    channel = F.regexp_replace("channel", "^source=", "")
    return found.groupBy("stage", channel.alias("channel")).agg((F.count(F.lit(1)) > 0).alias("has_files"))


def _digest_sql(text: str) -> str:
    return f"CAST(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)) AS BIGINT)"


def _digest(text: Column) -> Column:
    """Sum of the first 32 bits of the MD5 of each text, whatever their order."""
    return F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"))


@query(
    "text_tree",
    f"""SELECT source AS channel, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars, {_digest_sql('line')} AS lines_digest
  FROM (SELECT source, unnest(string_split(replace(text, chr(13), ' '), chr(10))) AS line FROM documents) GROUP BY 1""",
)
def text_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written as files of a few texts per channel by all tasks, read back whole and compared by their lines."""
    root = scratch_dir(spark, "texts")
    docs = views.table(spark, sf_dir, "documents").select("source", F.replace("text", F.lit("\r"), F.lit(" ")).alias("text"))
    writers.write_texts(docs.where(F.col("text").isNotNull()), "source", root)
    found = files_source.text_files(spark, root, ".txt")
    channel = F.regexp_extract("path", "/source=([^/]+)/", 1).alias("channel")
    lines = F.split(F.regexp_replace("text", r"\n\z", ""), "\n")
    rows = found.select(channel, F.explode(lines).alias("line"))
    return rows.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).cast("long").alias("n_chars"), _digest(F.col("line")).alias("lines_digest")
    )


@query("raw_pending", "SELECT 'text' AS content_type, CAST(3 AS BIGINT) AS n_pending, count(*) > 0 AS any FROM documents")
def raw_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts as raw files, four at least and as many as the table has parts; all but the last three by name are cleaned."""
    root = scratch_dir(spark, "raw")
    parts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").rdd.getNumPartitions()
    views.table(spark, sf_dir, "documents").select("text").repartition(max(4, parts)).write.text(f"{root}/text")
    items = files_source.raw_items(spark, root)
    last = [r["stem"] for r in items.orderBy(F.desc("stem")).limit(3).select("stem").collect()]
    cleaned = items.where(~F.col("stem").isin(last)).select("content_type", "stem", F.lit(5).alias("size"))
    todo = files_source.pending_raw(items, cleaned)
    return todo.groupBy("content_type").agg(F.count(F.lit(1)).alias("n_pending"), (F.sum("raw_bytes") > 0).alias("any"))


# --- model evaluation ---------------------------------------------------------

_PRED = """pr AS (SELECT 'm' || m AS model, CASE WHEN quality = 1 THEN 'good_' ELSE 'bad_' END || doc_id || '.sh' AS item,
  CASE WHEN quality = 1 THEN 'PASS' ELSE 'FAIL' END AS expected, CASE WHEN (doc_id * (m + 3)) % 41 = 7 THEN 'ERROR'
  WHEN (doc_id * (m + 5)) % 13 < m THEN CASE WHEN quality = 1 THEN 'FAIL' ELSE 'PASS' END ELSE CASE WHEN quality = 1 THEN 'PASS' ELSE 'FAIL' END END AS predicted, doc_id
  FROM labels, range(6) t(m) WHERE NOT (m = 4 AND toxic = 1)),
pm AS (SELECT *, CASE WHEN expected = predicted THEN 'Y' ELSE 'N' END AS match FROM pr)"""
_METRICS = """cm AS (SELECT model, count(*) FILTER (expected = 'PASS' AND predicted = 'PASS') AS tp, count(*) FILTER (expected = 'FAIL' AND predicted = 'FAIL') AS tn,
  count(*) FILTER (expected = 'FAIL' AND predicted = 'PASS') AS fp, count(*) FILTER (expected = 'PASS' AND predicted = 'FAIL') AS fn, count(*) AS total
  FROM pm WHERE predicted <> 'ERROR' GROUP BY 1),
mt AS (SELECT *, round((tp + tn)::DOUBLE / total, 6) AS accuracy, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM cm)"""


@query("classification_metrics", with_(_PRED, _METRICS) + "SELECT * FROM mt")
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.by_f1(E.metrics(views.predictions(spark, sf_dir)))


@query(
    "item_difficulty",
    with_(_PRED) + """SELECT item, expected, count(*) FILTER (match = 'N') AS misclassified, CASE WHEN starts_with(item, 'bad_') THEN 'bad' ELSE 'good' END AS kind,
  round(count(*) FILTER (match = 'N') * 100.0::DOUBLE / 6, 4) AS misclassified_pct FROM pm GROUP BY 1, 2""",
)
def item_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.difficulty(views.predictions(spark, sf_dir))


@query(
    "correctness_matrix",
    with_(_PRED) + "SELECT item, " + ", ".join(f"max((match = 'Y')::BIGINT) FILTER (model = '{m}') AS {m}" for m in views.MODELS) + " FROM pm GROUP BY 1",
)
def correctness_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.correctness_matrix(views.predictions(spark, sf_dir), views.MODELS)


@query(
    "item_set_gaps",
    with_(_PRED) + """SELECT m.model, i.item, 'missing' AS gap FROM (SELECT DISTINCT model FROM pm) m, (SELECT item FROM pm WHERE model = 'm0') i
  WHERE NOT EXISTS (SELECT 1 FROM pm WHERE pm.model = m.model AND pm.item = i.item)
  UNION ALL SELECT model, item, 'extra' FROM pm WHERE item NOT IN (SELECT item FROM pm WHERE model = 'm0')""",
)
def item_set_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.item_set_gaps(views.predictions(spark, sf_dir), "m0")


@query(
    "prediction_files",
    with_(_PRED) + f"""SELECT model, count(*) AS n, count(*) FILTER (match = 'Y') AS n_right, {_digest_sql("concat_ws(',', item, expected, predicted, match)")} AS rows_digest
  FROM pm GROUP BY 1""",
)
def prediction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV folder per model, written in files of bounded length by all tasks, collected and checked on the way back."""
    root = scratch_dir(spark, "predictions")
    rows = views.predictions(spark, sf_dir)
    out = rows.select(
        F.concat(F.lit("/tests/"), "item").alias("Script"), F.col("expected").alias("Expected"),
        F.col("predicted").alias("Predicted"), F.col("match").alias("Match"), F.lit(None).cast("string").alias("Error"), "model",
    )
    out.write.partitionBy("model").option("maxRecordsPerFile", writers.FILE_ROWS).csv(root, header=True, quote='"', escape='"')
    back = files_source.prediction_csvs(spark, root, by_folder=True)
    row = F.concat_ws(",", "item", "expected", "predicted", "match")
    return back.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("match") == "Y").alias("n_right"), _digest(row).alias("rows_digest"))


_BOARD = """bd AS (SELECT 'u' || user_id AS model, CAST(sum(value) * 10 AS BIGINT) AS time_ms, round((count(*) FILTER (event_type = 'purchase'))::DOUBLE / count(*), 6) AS f1,
  1 + user_id % 9 AS size_gb FROM events GROUP BY user_id)"""


def _board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score board with one row per user: time, score, size."""
    events = views.table(spark, sf_dir, "events")
    return events.groupBy("user_id").agg(
        F.round(F.sum(F.round(F.col("value") * 100).cast("long")) / 10).cast("long").alias("time_ms"),
        F.round(F.count_if(F.col("event_type") == "purchase") / F.count(F.lit(1)), 6).alias("f1"),
    ).select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("model"), "time_ms", "f1", (F.col("user_id") % 9 + 1).alias("size_gb"))


_BOARD = _BOARD.replace("CAST(sum(value) * 10 AS BIGINT)", "CAST(round(sum(CAST(round(value * 100) AS BIGINT)) / 10) AS BIGINT)")
_FRONT = "fr AS (SELECT * FROM bd b WHERE time_ms > 0 AND NOT EXISTS (SELECT 1 FROM bd o WHERE o.time_ms > 0 AND o.time_ms < b.time_ms AND o.f1 > b.f1))"


@query("pareto_front", with_(_BOARD, _FRONT) + "SELECT model, time_ms, f1 FROM fr")
def pareto_front(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.pareto_front(_board(spark, sf_dir)).select("model", "time_ms", "f1")


_PICKS = """SELECT 'speed' AS pick, 1 AS position, (SELECT model FROM bd WHERE f1 >= 0.2 ORDER BY time_ms, model LIMIT 1) AS model
  UNION ALL SELECT 'accuracy', 1, (SELECT model FROM bd ORDER BY f1 DESC, model LIMIT 1)
  UNION ALL SELECT 'size', 1, (SELECT model FROM bd ORDER BY round(f1 / size_gb, 9) DESC, model LIMIT 1)
  UNION ALL SELECT 'balanced', r, model FROM (SELECT model, row_number() OVER (ORDER BY by_ DESC NULLS LAST, model) AS r FROM (
    SELECT b.model, CASE WHEN n >= 3 THEN b.f1 ELSE round((b.f1 - lo) / (hi - lo) * 0.6 + (1 - (b.time_ms - t0)::DOUBLE / (t1 - t0)) * 0.4, 9) END AS by_
    FROM bd b, (SELECT count(*) AS n FROM fr), (SELECT min(f1) AS lo, max(f1) AS hi, min(time_ms) AS t0, max(time_ms) AS t1 FROM bd)
    WHERE n < 3 OR b.model IN (SELECT model FROM fr))) WHERE r <= 3"""


@query("model_picks", with_(_BOARD, _FRONT) + _PICKS)
def model_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.picks(materialize(_board(spark, sf_dir), "board"), 0.2)


@query(
    "label_names",
    """SELECT doc_id, CASE WHEN q = '' THEN '' WHEN starts_with(upper(q), 'Q4') THEN '4bit' WHEN starts_with(upper(q), 'Q5') THEN '5bit' WHEN starts_with(upper(q), 'Q6') THEN '6bit'
  WHEN starts_with(upper(q), 'Q8') THEN '8bit' ELSE lower(q) END AS bits, CASE WHEN starts_with(e, 'bad_') THEN 'bad' WHEN starts_with(e, 'good_') THEN 'good' ELSE 'unknown' END AS kind
  FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'q' || (doc_id % 10) || '_K' || upper(lang) END AS q,
    CASE doc_id % 3 WHEN 0 THEN 'bad_' WHEN 1 THEN 'good_' ELSE '' END || source AS e FROM documents)""",
)
def label_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    q = F.when(d % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("q"), (d % 10).cast("string"), F.lit("_K"), F.upper("lang")))
    e = F.concat(F.when(d % 3 == 0, F.lit("bad_")).when(d % 3 == 1, F.lit("good_")).otherwise(F.lit("")), "source")
    return views.table(spark, sf_dir, "documents").select("doc_id", T.quantization_label(q).alias("bits"), T.example_kind(e).alias("kind"))


# --- articles -----------------------------------------------------------------


def _article_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A front-matter file per document; some break a rule."""
    d = F.col("doc_id")
    n = d.cast("string")
    slug = F.when(d % 50 == 7, F.concat(F.lit("Doc_"), n)).when(d % 50 == 8, F.lit("shared")).otherwise(F.concat(F.lit("doc-"), n))
    day = F.date_format(F.date_add(F.lit(views.FIRST_DAY), (d % 90).cast("int")), "yyyy-MM-dd")
    date = F.when(d % 50 == 9, F.lit("2024-13-40")).otherwise(day)
    tags = F.when(d % 50 == 10, F.lit("tags: []")).when(d % 2 == 0, F.concat(F.lit("tags: ["), "lang", F.lit(', "x"]'))).otherwise(
        F.concat(F.lit("tags:\n  - "), "lang", F.lit("\n  - x"))
    )
    front = F.concat(
        F.lit("---\ntitle: \"T "), n, F.lit("\"\nsubtitle: s\nslug: "), slug, F.lit("\nauthor: "),
        F.when(d % 50 == 11, F.lit("")).otherwise(F.lit("a b")), F.lit("\ndate: "), date, F.lit("\ndateline: CITY\n"), tags,
        F.lit("\nsummary: z\n"), F.when(d % 50 == 12, F.lit("")).otherwise(F.lit("image: i.png\n")),
        F.lit("---\n"),
    )
    body = F.when(d % 50 == 14, F.lit(" \n")).otherwise(
        F.concat(
            F.lit("# Head\n\n**NEW YORK, N.Y.** — start\n\n---\nOne *two* `x` [t](u) line.\n\n![a](https://h.org/"), n,
            F.lit(".png)\n\nDoc **"), "source", F.lit("** end."),
        )
    )
    name = F.concat(F.lit("doc-"), n, F.when(d % 50 == 15, F.lit(".txt")).otherwise(F.lit(".md")))
    content = F.when(d % 50 == 13, F.concat(F.lit("no mark\n"), body)).otherwise(F.concat(front, body))
    return views.table(spark, sf_dir, "documents").select("doc_id", name.alias("name"), content.alias("content"))


_RULES = [
    ("doc_id % 50 = 15", "file extension"), ("doc_id % 50 = 13", "front matter opens"), ("doc_id % 50 = 11", "field author"),
    ("doc_id % 50 = 10", "field tags"), ("doc_id % 50 = 12", "field image"), ("doc_id % 50 = 14", "body"), ("doc_id % 50 = 7", "slug pattern"),
    ("doc_id % 50 = 9", "date format"), ("doc_id % 50 = 8 AND (SELECT count(*) FROM documents WHERE doc_id % 50 = 8) > 1", "slug unique"),
    ("doc_id % 50 IN (7, 8)", "name equals slug"),
]
_VIOL = "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, r in _RULES) + ")"


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.parse_articles(_article_files(spark, sf_dir))


@query("article_violations", f"SELECT doc_id, {_VIOL} AS violations FROM documents")
def article_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.violations(_parsed(spark, sf_dir))
    return out.select("doc_id", F.array_join("violations", "; ").alias("violations"))


@query(
    "article_fields",
    """SELECT doc_id, CASE WHEN doc_id % 50 <> 13 THEN 'T ' || doc_id END AS title,
  CASE WHEN doc_id % 50 = 13 THEN NULL WHEN doc_id % 50 = 10 THEN '' ELSE lang || ',x' END AS tags,
  CASE WHEN doc_id % 50 IN (13, 14) THEN '' ELSE 'NEW YORK, N.Y.' END AS dateline,
  CASE WHEN doc_id % 50 IN (13, 14) THEN '' ELSE 'https://h.org/' || doc_id || '.png' END AS images FROM documents""",
)
def article_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select(
        "doc_id", F.col("fm_title").alias("title"), F.array_join("fm_tags", ",").alias("tags"),
        F.col("body_dateline").alias("dateline"), F.array_join("images", ",").alias("images"),
    )


@query(
    "article_paragraphs",
    """SELECT doc_id, CASE WHEN doc_id % 50 IN (13, 14) THEN '' ELSE '!a' END AS image_block,
  CASE WHEN doc_id % 50 IN (13, 14) THEN '' ELSE 'Doc ' || source || ' end.' END AS last_paragraph FROM documents""",
)
def article_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("paragraphs")
    return _parsed(spark, sf_dir).select(
        "doc_id",
        F.array_join(F.filter(p, lambda x: x.startswith("!")), "|").alias("image_block"),
        F.array_join(F.filter(p, lambda x: x.startswith("Doc ")), "|").alias("last_paragraph"),
    )


def _typed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents behind a front matter of every value type; most classes break one rule."""
    d = F.col("doc_id")
    n = d.cast("string")
    case = F.pmod(d, F.lit(8))
    tags = F.when(case == 2, F.lit('["a, b", 7]')).otherwise(F.concat(F.lit('["a, b", '), F.lit("'"), "lang", F.lit("' ]  # two")))
    author = F.when(case == 1, F.lit("12")).otherwise(F.lit("a b"))
    day = F.when(case == 3, F.lit("2024-01-02 10:00:00")).when(case == 7, F.lit('"2024-02-30"')).otherwise(F.lit("2024-01-02"))
    title = F.concat(F.lit('"T \\"'), n, F.lit('\\" \\\\n"'))
    front = F.concat(
        F.lit("# head\ntitle: "), title, F.lit("\nsubtitle: 'it''s'\nslug:\n  doc-"), n, F.lit("\nauthor: "), author, F.lit("\ndate: "), day,
        F.lit("\ndateline: CITY\ntags: "), tags, F.lit("\nsummary: >-\n  first of\n  "), "source", F.lit("\n\n  second\nimage: i.png\nmeta:\n  note: |\n    x\n      "),
        "lang", F.lit("\n  draft: yes"), F.when(case == 4, F.lit("\noops")).otherwise(F.lit("")),
    )
    front = F.when(case == 5, F.lit("- a\n- b: c")).otherwise(front)
    content = F.concat(F.lit("---\n"), front, F.lit("\n---\n"), F.coalesce("text", F.lit("")))
    return views.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc-"), n, F.lit(".md")).alias("name"), content.alias("content"))


_BLOCKS = "string_split_regex(coalesce(text, ''), '\\n[ \\t\\r]*\\n')"
_PROSE = f"""list_filter(list_transform(list_filter(list_transform({_BLOCKS}, lambda b: {strip('b')}),
  lambda b: b <> '' AND NOT regexp_matches(b, '^(#{{1,6}}[ \\t]|---|```)') AND NOT (contains(b, '**') AND contains(b, '—'))),
  lambda b: {strip("regexp_replace(regexp_replace(b, '[*`]', '', 'g'), '[[]([^]\\n]+)[]][(][^)\\n]+[)]', '\\1', 'g')")}), lambda b: b <> '')"""


@query(
    "article_texts",
    f"""SELECT doc_id, c <> 5 AS mapped, CASE WHEN c <> 5 THEN 'T "' || doc_id || '" \\n' END AS title, CASE WHEN c <> 5 THEN 'first of ' || source || chr(10) || 'second' END AS summary,
  CASE WHEN c <> 5 THEN 'x' || chr(10) || '  ' || lang || chr(10) END AS note, CASE WHEN c <> 5 THEN CASE WHEN c = 2 THEN 'str int' ELSE 'str str' END END AS tag_kinds,
  concat_ws('; ', CASE c WHEN 5 THEN 'front matter is a mapping' WHEN 4 THEN 'front matter parses' WHEN 1 THEN 'field author' WHEN 3 THEN 'field date' WHEN 2 THEN 'field tags' END,
    CASE WHEN c NOT IN (4, 5) AND {strip("coalesce(text, '')")} = '' THEN 'body' END,
    CASE WHEN c IN (3, 7) THEN 'date format' END) AS violations,
  CAST(len(prose) AS BIGINT) AS n_paragraphs, sha256(array_to_string(prose, chr(10))) AS prose_sha256
  FROM (SELECT doc_id, source, lang, text, doc_id % 8 AS c, {_PROSE} AS prose FROM documents)""",
)
def article_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields and rules of articles whose bodies are the documents' whole texts; marks are taken out of the prose compared."""
    out = A.violations(A.parse_articles(_typed_files(spark, sf_dir)))
    fm = F.col("fm")
    bare = F.filter(F.transform("paragraphs", lambda p: T.strip_ws(F.regexp_replace(p, "[*`]", ""))), lambda p: p != "")
    return out.select(
        "doc_id", FM.is_mapping(fm).alias("mapped"), F.col("fm_title").alias("title"), F.col("fm_summary").alias("summary"),
        FM.find(fm, "meta.note")["text"].alias("note"),
        F.array_join(F.transform(FM.find(fm, "tags")["items"], lambda i: i["kind"]), " ").alias("tag_kinds"),
        F.array_join("violations", "; ").alias("violations"), F.size(bare).cast("long").alias("n_paragraphs"),
        F.sha2(F.array_join(bare, "\n"), 256).alias("prose_sha256"),
    )


@query(
    "heading_block_dropped",
    """SELECT doc_id, CASE WHEN lang = 'fr' THEN NULL ELSE '---' || chr(10) || 'a: ' || doc_id || chr(10) || '---' || chr(10) || CASE
  WHEN lang = 'en' THEN text || chr(10) || '---' WHEN regexp_matches(chr(10) || text || chr(10), '\\n\\s*---\\s*\\n') THEN regexp_extract(text || chr(10), '(?s)^(?:.*?\\n)??[ \\t]*---[ \\t]*\\n(.*)\\n$', 1)
  ELSE '# H1' || chr(10) || text END END AS kept FROM documents""",
)
def heading_block_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' texts behind front matter; French ones lack the opening mark, English ones carry the block."""
    lead = F.when(F.col("lang") == "fr", F.lit("x\n")).otherwise(F.lit(""))
    mid = F.when(F.col("lang") == "en", F.concat(F.lit("# H1\n## H2\n---\n"), "text", F.lit("\n---"))).otherwise(
        F.concat(F.lit("# H1\n"), "text")
    )
    text = F.concat(lead, F.lit("---\na: "), F.col("doc_id").cast("string"), F.lit("\n---\n"), mid)
    return views.table(spark, sf_dir, "documents").select("doc_id", T.drop_heading_block(text).alias("kept"))


@query(
    "front_page",
    f"""SELECT rank, slug, CASE WHEN rank = 1 THEN 'hero' WHEN rank <= 6 THEN 'featured' WHEN rank = 7 THEN 'secondary' WHEN rank <= 13 THEN 'sidebar' ELSE 'briefs' END AS slot,
  CASE WHEN rank BETWEEN 8 AND 13 THEN (rank - 8) // 3 WHEN rank >= 14 THEN (rank - 14) // 2 ELSE 0 END AS "column",
  CASE WHEN rank = 1 THEN 0 WHEN rank <= 6 THEN rank - 2 WHEN rank = 7 THEN 0 WHEN rank <= 13 THEN (rank - 8) % 3 ELSE (rank - 14) % 2 END AS position FROM
  (SELECT 'doc-' || doc_id AS slug, row_number() OVER (ORDER BY doc_id % 90 DESC, 'doc-' || doc_id) AS rank FROM documents WHERE {_VIOL} = '') WHERE rank <= 21""",
)
def front_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = A.violations(_parsed(spark, sf_dir)).where(F.size("violations") == 0).select("fm_date", F.col("fm_slug").alias("slug"))
    return A.front_page(materialize(valid, "articles"), "fm_date", "slug").select(
        "rank", "slug", "slot", "column", "position"
    )


# --- hierarchies --------------------------------------------------------------

_NODES = """nd AS (SELECT doc_id AS id, source AS title, CASE WHEN doc_id = 0 THEN NULL WHEN doc_id % 97 = 1 THEN doc_id WHEN doc_id % 97 = 2 THEN doc_id + 1
  WHEN doc_id % 97 = 3 THEN doc_id - 1 WHEN doc_id % 10 = 9 THEN doc_id - 1 WHEN doc_id % 5 = 4 THEN doc_id - 5 ELSE doc_id // 2 END AS parent_id FROM documents)"""


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder per document: deep chains, self loops and two-node cycles."""
    d = F.col("doc_id")
    parent = (
        F.when(d == 0, F.lit(None).cast("long")).when(d % 97 == 1, d).when(d % 97 == 2, d + 1).when(d % 97 == 3, d - 1)
        .when(d % 10 == 9, d - 1).when(d % 5 == 4, d - 5).otherwise(F.floor(d / 2))
    )
    return views.table(spark, sf_dir, "documents").select(d.alias("id"), F.col("source").alias("title"), parent.cast("long").alias("parent_id"))


_PATHS = """pa AS (WITH RECURSIVE r AS (SELECT id AS leaf, id AS cur, [id] AS seen, title AS path, 1 AS depth FROM nd
  UNION ALL SELECT r.leaf, n.id, list_append(seen, n.id), n.title || '->' || r.path, depth + 1 FROM r JOIN nd c ON c.id = r.cur JOIN nd n ON n.id = c.parent_id
  WHERE depth < 20 AND NOT list_contains(seen, n.id)) SELECT leaf AS id, arg_max(path, depth) AS path FROM r GROUP BY 1)"""


@query("folder_paths", with_(_NODES, _PATHS) + "SELECT id, path FROM pa")
def folder_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.folder_paths(_nodes(spark, sf_dir))


@query(
    "bookmark_lines",
    with_(_NODES, _PATHS, "bm AS (SELECT CASE page_id % 9 WHEN 0 THEN -1 WHEN 1 THEN -99 WHEN 2 THEN 900000 + page_id ELSE page_id END AS cid, url FROM pages)")
    + "SELECT CASE WHEN cid = -1 THEN 'Unsorted' WHEN cid = -99 THEN 'Trash' ELSE coalesce(path, 'Unknown(' || cid || ')') END || ':' || url AS line FROM bm LEFT JOIN pa ON pa.id = cid",
)
def bookmark_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookmarks read from exported JSON, with their folder path in front."""
    p = F.col("page_id")
    cid = F.when(p % 9 == 0, F.lit(-1)).when(p % 9 == 1, F.lit(-99)).when(p % 9 == 2, p + 900000).otherwise(p)
    root = scratch_dir(spark, "bookmarks")
    views.table(spark, sf_dir, "pages").select(cid.alias("collectionId"), F.col("url").alias("link")).write.json(f"{root}/items")
    _nodes(spark, sf_dir).select(
        F.col("id").alias("_id"), "title", F.when(F.col("parent_id").isNotNull(), F.struct(F.col("parent_id").alias("$id"))).alias("parent")
    ).write.json(f"{root}/folders")
    marks = files_source.bookmarks_json(spark, f"{root}/items")
    folders = files_source.collections_json(spark, f"{root}/folders")
    return H.with_paths(marks, folders, "collection_id").select(F.concat("path", F.lit(":"), "link").alias("line"))


_LEAVES = """lf AS (SELECT conv_id, turn // 2 AS node, min(turn) AS from_idx, max(turn) + 1 AS to_idx, string_agg(content, ' ' ORDER BY turn) AS node_text,
  arg_min(start_ms, turn) AS ms FROM cues GROUP BY 1, 2)"""


@query(
    "leaf_export",
    with_(*CUES, _LEAVES) + """SELECT conv_id, 'n' || node AS node_id, 'Talk_ ' || conv_id AS folder, 'leaf_' || lpad(CAST(rn AS VARCHAR), 3, '0') AS leaf,
  'Talk_ ' || conv_id || '_leaf_' || lpad(CAST(rn AS VARCHAR), 3, '0') AS citation_key, node_text, true AS in_bounds, link,
  CAST(to_json({'citation_key': 'Talk_ ' || conv_id || '_leaf_' || lpad(CAST(rn AS VARCHAR), 3, '0'), 'source_type': 'youtube', 'common': {'title': 'Talk: ' || conv_id, 'url': link},
    'source_data': {'channel': 'c', 'node_id': 'n' || node, 'leaf_index': rn, 'start_entry_idx': from_idx, 'end_entry_idx_exclusive': to_idx}}) AS VARCHAR) AS citation
  FROM (SELECT *, 'https://example.com/w' || CASE WHEN conv_id % 2 = 0 THEN '?v=' || conv_id || '&t=' ELSE '?t=' END || ms // 1000 AS link, row_number() OVER (PARTITION BY conv_id ORDER BY from_idx) AS rn FROM lf)""",
)
def leaf_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of a two-level topic tree: spans of two turns below one root."""
    cues = materialize(views.cues(spark, sf_dir), "cues")
    spans = cues.groupBy("conv_id", F.floor(F.col("turn") / 2).alias("node")).agg(
        F.min("turn").alias("from_idx"), (F.max("turn") + 1).alias("to_idx")
    )
    leaf_nodes = spans.select(
        "conv_id", F.concat(F.lit("n"), F.col("node").cast("string")).alias("node_id"), "from_idx", "to_idx",
        F.array().cast("array<string>").alias("children_ids"),
    )
    roots = spans.groupBy("conv_id").agg(F.min("from_idx").alias("from_idx"), F.max("to_idx").alias("to_idx")).select(
        "conv_id", F.lit("root").alias("node_id"), "from_idx", "to_idx", F.array(F.lit("n0")).alias("children_ids")
    )
    found = H.leaves(leaf_nodes.unionByName(roots)).drop("children_ids")
    texts = Q.span_text(cues, H.number_leaves(found, "conv_id", "from_idx"), "conv_id", "turn", "content", ["node_id"])
    c = F.col("conv_id").cast("string")
    url = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("https://example.com/w?v="), c)).otherwise(F.lit("https://example.com/w"))
    rows = texts.withColumns({
        "title": F.concat(F.lit("Talk: "), c), "url": url, "channel": F.lit("c"), "upload_date": F.lit(None).cast("string"),
    })
    return H.citations(rows).select("conv_id", "node_id", "folder", "leaf", "citation_key", "node_text", "in_bounds", "link", "citation")


@query(
    "timed_links",
    "SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 't=' || page_id * 7 AS link FROM pages",
)
def timed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "pages").select("page_id", with_timestamp(F.col("url"), F.col("page_id") * 7).alias("link"))

