"""Queries over the corpus index, themes, timeline and digest (documents)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import strip_ws
from ..functions.times import bucket_key, compact_date
from ..operators import corpus as C
from ..operators import inventory as I
from ..operators import matching as M
from ..operators import publications as P
from ..operators import tfidf
from ..plans import markdown as report_lines
from ..plans import reports, views
from ..session import materialize, scratch_dir
from ..sources import files, writers
from .base import query
from .sqltext import CANDIDATES, CHANNELS, CORPUS, markdown, month_key, n_words, rep, strip, tfidf as tfidf_sql, week_key, with_

DOCS = f"docs AS (SELECT doc_id, channel, title, upload_date, {markdown('text')} AS document FROM cand)"
THEMES = [CORPUS, CANDIDATES, DOCS, *tfidf_sql("docs")]


def _candidates(spark: SparkSession, sf_dir: str, reference=views.REFERENCE) -> DataFrame:
    return C.candidates(views.corpus(spark, sf_dir), reference, 30, strict=False)


def _docs(spark: SparkSession, sf_dir: str, reference=views.REFERENCE) -> DataFrame:
    rows = reports.document_text(_candidates(spark, sf_dir, reference), "text")
    return rows.select("doc_id", "channel", "title", "upload_date", "document")


@query(
    "normalized_summaries",
    with_(CORPUS) + f"""SELECT doc_id, nullif(d, '') AS normalized, CASE WHEN d <> '' THEN {n_words('d')} END AS summary_words,
  CASE WHEN d <> '' THEN length(d) END AS summary_chars
  FROM (SELECT doc_id, {markdown("'> # ' || text")} AS d FROM corpus WHERE has_summary)""",
)
def normalized_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.corpus(spark, sf_dir).where("has_summary").withColumn("quoted", F.concat(F.lit("> # "), "text"))
    return C.summary_stats(rows, "quoted").select("doc_id", "normalized", "summary_words", "summary_chars")


@query("theme_candidates", with_(CORPUS, CANDIDATES) + "SELECT doc_id, channel, CAST(upload_date AS VARCHAR) AS upload_date FROM cand")
def theme_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.candidates(views.corpus(spark, sf_dir), views.REFERENCE, 30)
    return rows.select("doc_id", "channel", F.col("upload_date").cast("string").alias("upload_date"))


@query(
    "theme_candidates_channel",
    with_(CORPUS, CANDIDATES) + "SELECT doc_id, channel, CAST(upload_date AS VARCHAR) AS upload_date FROM cand WHERE channel = 'src3'",
)
def theme_candidates_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.candidates(views.corpus(spark, sf_dir), views.REFERENCE, 30, channel="src3")
    return rows.select("doc_id", "channel", F.col("upload_date").cast("string").alias("upload_date"))


@query("theme_vocabulary", with_(*THEMES) + "SELECT term, cf, df FROM vocab")
def theme_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.vocabulary(tfidf.term_counts(_docs(spark, sf_dir).select("document"), "document"), [])


@query(
    "theme_terms",
    with_(*THEMES) + """SELECT row_number() OVER (ORDER BY score DESC, term) AS rank, term, score, document_frequency,
  array_to_string(channels, ',') AS channels FROM found WHERE NOT contains(term, ' ') ORDER BY score DESC, term LIMIT 50""",
)
def theme_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tfidf.entries(reports.theme_weights(_docs(spark, sf_dir), "doc_id"))
    return reports.term_report(found).withColumn("channels", F.array_join("channels", ","))


_PHRASES = """phrases AS (SELECT row_number() OVER (ORDER BY document_frequency DESC, score DESC, term) AS rank, term, score,
  document_frequency, array_to_string(channels, ',') AS channels FROM found
  WHERE contains(term, ' ') AND document_frequency >= 2 ORDER BY document_frequency DESC, score DESC, term LIMIT 30)"""


@query("theme_phrases", with_(*THEMES, _PHRASES) + "SELECT * FROM phrases")
def theme_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tfidf.entries(reports.theme_weights(_docs(spark, sf_dir), "doc_id"))
    return reports.phrase_report(found).withColumn("channels", F.array_join("channels", ","))


@query(
    "theme_videos",
    with_(*THEMES, _PHRASES) + """SELECT w.term, w.doc_id, row_number() OVER (PARTITION BY w.term
    ORDER BY round(weight, 9) DESC, w.channel, w.doc_id) AS position
  FROM w JOIN phrases p ON p.term = w.term QUALIFY position <= 10""",
)
def theme_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = reports.theme_weights(_docs(spark, sf_dir), "doc_id")
    phrases = reports.phrase_report(tfidf.entries(weighted))
    top = tfidf.top_documents(weighted, phrases, "doc_id", "title", reports.TOP_VIDEOS)
    return top.select("term", "doc_id", F.col("position").cast("long").alias("position"))


_BOTH = [
    "said AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS transcript FROM conversations GROUP BY 1)",
    f"""docs AS (SELECT doc_id, channel, trim({markdown('text')} || CASE WHEN transcript IS NULL THEN '' ELSE ' ' || {markdown('transcript')} END) AS document
  FROM cand LEFT JOIN said ON conv_id = doc_id)""",
]


@query(
    "theme_terms_with_transcript",
    with_(CORPUS, CANDIDATES, *_BOTH, *tfidf_sql("docs")) + """SELECT term, score, document_frequency FROM found
  WHERE NOT contains(term, ' ') ORDER BY score DESC, term LIMIT 50""",
)
def theme_terms_with_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary text with the transcript of the same number appended, where there is one."""
    turns = views.table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    said = turns.groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("l"))
    said = said.select("doc_id", F.array_join(F.transform("l", lambda t: t["text"]), " ").alias("transcript"))
    rows = _candidates(spark, sf_dir).join(said, "doc_id", "left")
    docs = reports.document_text(rows, "text", "transcript").select("doc_id", "channel", "document")
    found = tfidf.entries(reports.theme_weights(docs, "doc_id"))
    return tfidf.top_terms(found, 50).select("term", "score", "document_frequency")


def _timeline_sql(key: str) -> str:
    docs = f"docs AS (SELECT doc_id, channel, {key} AS bucket, {markdown('text')} AS document FROM cand)"
    return with_(
        CORPUS, CANDIDATES, docs, *tfidf_sql("docs", "bucket"),
        """t AS (SELECT bucket, term, row_number() OVER (PARTITION BY bucket ORDER BY score DESC, term) AS r FROM found
  WHERE NOT contains(term, ' ') QUALIFY r <= 5)""",
        """p AS (SELECT bucket, term, row_number() OVER (PARTITION BY bucket ORDER BY document_frequency DESC, score DESC, term) AS r
  FROM found WHERE contains(term, ' ') AND document_frequency >= 2 QUALIFY r <= 5)""",
        "c AS (SELECT bucket, channel, count(*) AS k FROM docs GROUP BY ALL)",
    ) + """SELECT bucket, CAST(sum(k) AS BIGINT) AS video_count, string_agg(channel || '=' || k, ',' ORDER BY channel) AS channels,
  coalesce((SELECT string_agg(term, ',' ORDER BY r) FROM t WHERE t.bucket = c.bucket), '') AS top_terms,
  coalesce((SELECT string_agg(term, ',' ORDER BY r) FROM p WHERE p.bucket = c.bucket), '') AS top_phrases
  FROM c GROUP BY bucket"""


def _timeline(spark: SparkSession, sf_dir: str, bucket: str) -> DataFrame:
    rows = reports.timeline(_docs(spark, sf_dir), "doc_id", bucket)
    pairs = F.transform(F.map_entries("channels"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return rows.select(
        "bucket", "video_count", F.array_join(pairs, ",").alias("channels"),
        F.array_join("top_terms", ",").alias("top_terms"), F.array_join("top_phrases", ",").alias("top_phrases"),
    )


@query("timeline_week", _timeline_sql(week_key("upload_date")))
def timeline_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timeline(spark, sf_dir, "week")


@query("timeline_month", _timeline_sql(month_key("upload_date")))
def timeline_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timeline(spark, sf_dir, "month")


@query(
    "bucket_keys",
    f"""SELECT doc_id, {week_key('d')} AS week, {month_key('d')} AS month
  FROM (SELECT doc_id, DATE '2020-12-20' + CAST(doc_id AS INTEGER) AS d FROM documents)""",
)
def bucket_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2020-12-20").cast("date"), F.col("doc_id").cast("int"))
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", bucket_key(day, "week").alias("week"), bucket_key(day, "month").alias("month")
    )


_PREVIOUS = "pcand AS (SELECT * FROM corpus WHERE has_summary AND upload_date >= DATE '2024-02-09' - 30)"
_PDOCS = f"pdocs AS (SELECT doc_id, channel, {markdown('text')} AS document FROM pcand)"


def _emerging_sql(picked: str) -> str:
    return with_(*THEMES, _PREVIOUS, _PDOCS, *tfidf_sql("pdocs", prefix="p_")) + f"""SELECT term FROM
  (SELECT term FROM found {picked}) EXCEPT SELECT term FROM (SELECT term FROM p_found {picked})"""


def _emerging(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Two runs are stored; what the newest has and the one before it lacks is read from storage."""
    import datetime as dt

    path = scratch_dir(spark, "runs")
    for day in (dt.date(2024, 2, 9), views.REFERENCE):
        found = materialize(tfidf.entries(reports.theme_weights(_docs(spark, sf_dir, day), "doc_id")), "themes")
        terms, phrases = tfidf.top_terms(found, reports.TOP_TERMS), tfidf.top_phrases(found, reports.TOP_PHRASES, reports.MIN_DOCUMENTS)
        writers.write_snapshot(terms, phrases, day.isoformat(), path)
    newest = writers.stored_run(spark, path, kind)
    return reports.emerging(newest, writers.stored_run(spark, path, kind, views.REFERENCE.isoformat()))


@query("emerging_terms", _emerging_sql("WHERE NOT contains(term, ' ') ORDER BY score DESC, term LIMIT 50"))
def emerging_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of the newest stored run that the run before it lacks."""
    return _emerging(spark, sf_dir, "term")


@query("emerging_phrases", _emerging_sql("WHERE contains(term, ' ') AND document_frequency >= 2 ORDER BY document_frequency DESC, score DESC, term LIMIT 30"))
def emerging_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of the newest stored run that the run before it lacks."""
    return _emerging(spark, sf_dir, "phrase")


def _written(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    """Report lines (position, line), written as one text file and read back."""
    path = scratch_dir(spark, name)
    writers.write_lines(lines, path)
    return files.ordered_lines(spark, path, ".txt").select("position", "line")


# Parts of the reports in SQL: a list of lines per row, numbered at the end over all parts.
_TERMS = "tm AS (SELECT row_number() OVER (ORDER BY score DESC, term) AS rank, * FROM found WHERE NOT contains(term, ' ') QUALIFY rank <= 50)"
_BUCKETS = [
    f"bdocs AS (SELECT doc_id, channel, {week_key('upload_date')} AS bucket, {markdown('text')} AS document FROM cand)",
    *tfidf_sql("bdocs", "bucket", prefix="b_"),
    "bt AS (SELECT bucket, term, row_number() OVER (PARTITION BY bucket ORDER BY score DESC, term) AS r FROM b_found WHERE NOT contains(term, ' ') QUALIFY r <= 5)",
    """bp AS (SELECT bucket, term, row_number() OVER (PARTITION BY bucket ORDER BY document_frequency DESC, score DESC, term) AS r
  FROM b_found WHERE contains(term, ' ') AND document_frequency >= 2 QUALIFY r <= 5)""",
    "bc AS (SELECT bucket, channel, count(*) AS k FROM bdocs GROUP BY ALL)",
    """bk AS (SELECT bucket, CAST(sum(k) AS BIGINT) AS n, string_agg(channel || ' (' || k || ')', ', ' ORDER BY channel) AS channels,
  coalesce((SELECT string_agg(term, ', ' ORDER BY r) FROM bt WHERE bt.bucket = bc.bucket), 'none') AS terms,
  coalesce((SELECT string_agg(term, ', ' ORDER BY r) FROM bp WHERE bp.bucket = bc.bucket), 'none') AS phrases FROM bc GROUP BY bucket)""",
]


def _tables_sql(section: int, level: str) -> str:
    return f"""SELECT {section} AS s, '' AS p, 0 AS m, CASE WHEN count(*) > 0 THEN ['', '{level} Top terms (TF-IDF)', '', '| Rank | Term | Score | Videos |', '|------|------|-------|--------|']
    ELSE ['', '{level} Top terms (TF-IDF)', '', '_No terms extracted._'] END AS lines FROM tm
  UNION ALL SELECT {section + 1}, '', rank, ['| ' || rank || ' | ' || replace(term, '|', '\\|') || ' | ' || printf('%.6f', score) || ' | ' || document_frequency || ' |'] FROM tm
  UNION ALL SELECT {section + 2}, '', 0, CASE WHEN count(*) > 0 THEN ['', '{level} Top phrases', '', '| Rank | Phrase | Doc frequency | Top channels |', '|------|--------|---------------|--------------|']
    ELSE ['', '{level} Top phrases', '', '_No phrases met the document-frequency threshold._'] END FROM phrases
  UNION ALL SELECT {section + 3}, '', rank, ['| ' || rank || ' | ' || replace(term, '|', '\\|') || ' | ' || document_frequency || ' | ' || replace(channels, ',', ', ') || ' |'] FROM phrases"""


def _report_sql(ctes: list[str], *parts: str) -> str:
    union = "\n  UNION ALL ".join(parts)
    return with_(*ctes, f"parts AS ({union})", "flat AS (SELECT s, p, m, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM parts)") + (
        "SELECT row_number() OVER (ORDER BY s, p, m, i) AS position, line FROM flat"
    )


@query(
    "themes_report",
    _report_sql(
        [*THEMES, _PHRASES, _TERMS],
        "SELECT 0 AS s, '' AS p, 0 AS m, ['# Themes Report', '', '- Lookback days: 30', '- Channel filter: all channels', '- Videos considered: ' || count(*)] AS lines FROM cand",
        _tables_sql(2, "##"),
    ),
)
def themes_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The themes report as Markdown, written as text and read back."""
    docs = _docs(spark, sf_dir)
    found = materialize(tfidf.entries(reports.theme_weights(docs, "doc_id")), "themes")
    return _written(spark, report_lines.theme_lines(docs, reports.term_report(found), reports.phrase_report(found), reports.LOOKBACK_DAYS), "themes-report")


@query(
    "timeline_report",
    _report_sql(
        [CORPUS, CANDIDATES, *_BUCKETS],
        """SELECT 0 AS s, '' AS p, 0 AS m, ['# Timeline Report', '', '- Lookback days: 30', '- Channel filter: all channels', '- Bucket type: week',
    '- Videos considered: ' || count(*)] AS lines FROM cand""",
        "SELECT 1, bucket, 0, ['', '## ' || bucket, '', '- Videos: ' || n, '- Channels: ' || channels, '- Top terms: ' || terms, '- Top phrases: ' || phrases] FROM bk",
        "SELECT 2, '', 0, ['', '_No videos in the lookback window._'] FROM bk HAVING count(*) = 0",
    ),
)
def timeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly timeline as Markdown, written as text and read back."""
    docs = _docs(spark, sf_dir)
    buckets = materialize(reports.timeline(docs, "doc_id", "week"), "buckets")
    return _written(spark, report_lines.timeline_lines(docs, buckets, "week", reports.LOOKBACK_DAYS), "timeline-report")


@query(
    "corpus_snapshot",
    with_(CORPUS) + """SELECT count(*) AS videos, count(*) FILTER (has_summary) AS with_summary,
  round(count(*) FILTER (has_summary) * 100.0 / count(*), 4) AS coverage_pct, CAST(min(upload_date) AS VARCHAR) AS first_date,
  CAST(max(upload_date) AS VARCHAR) AS last_date, count(DISTINCT channel) AS channels FROM corpus""",
)
def corpus_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = C.snapshot(views.corpus(spark, sf_dir))
    return snap.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


_DIGEST = _report_sql(
    [
        *THEMES, _PHRASES, _TERMS, _PREVIOUS, _PDOCS, *tfidf_sql("pdocs", prefix="p_"), *_BUCKETS,
        "new_terms AS (SELECT term FROM tm EXCEPT SELECT term FROM (SELECT term FROM p_found WHERE NOT contains(term, ' ') ORDER BY score DESC, term LIMIT 50))",
        """new_phrases AS (SELECT term FROM phrases EXCEPT SELECT term FROM
  (SELECT term FROM p_found WHERE contains(term, ' ') AND document_frequency >= 2 ORDER BY document_frequency DESC, score DESC, term LIMIT 30))""",
        """rd AS (SELECT p.rank, row_number() OVER (PARTITION BY w.term ORDER BY round(weight, 9) DESC, w.channel, w.doc_id) AS position, w.doc_id, w.channel
  FROM w JOIN phrases p ON p.term = w.term QUALIFY position <= 10)""",
        "snap AS (SELECT count(*) AS n, count(*) FILTER (has_summary) AS h, min(upload_date) AS lo, max(upload_date) AS hi, count(DISTINCT channel) AS c FROM corpus)",
    ],
    """SELECT 0 AS s, '' AS p, 0 AS m, ['# Research Digest', '', 'Generated: 2024-03-01', '', '## Corpus Snapshot', '', '- Videos indexed: ' || n,
    '- With summaries: ' || h || ' (' || printf('%.1f', round(h * 100.0 / n, 4)) || '%)', '- Date range: ' || lo || ' — ' || hi, '- Channels: ' || c,
    '', '## Top Themes (last 30 days)', '', '- Channel filter: all channels', '- Videos considered: ' || (SELECT count(*) FROM cand)] AS lines FROM snap""",
    _tables_sql(1, "###"),
    "SELECT 5, '', 0, ['', '## Timeline']",
    "SELECT 6, bucket, 0, ['', '### Week ' || bucket, '', '- Videos: ' || n, '- Top terms: ' || terms] FROM bk",
    "SELECT 7, '', 0, ['', '_No videos in the lookback window._'] FROM bk HAVING count(*) = 0",
    """SELECT 8, '', 0, ['', '## Emerging (vs previous run)', '', '- Previous run: 2024-02-09',
    '- New terms: ' || coalesce((SELECT string_agg(term, ', ' ORDER BY term) FROM new_terms), 'none'),
    '- New phrases: ' || coalesce((SELECT string_agg(term, ', ' ORDER BY term) FROM new_phrases), 'none'), '', '## Reading List']""",
    "SELECT 9, lpad(CAST(rank AS VARCHAR), 9, '0'), 0, ['', '### ' || term, ''] FROM phrases",
    """SELECT 9, lpad(CAST(rank AS VARCHAR), 9, '0'), position, [position || '. **Doc ' || doc_id || '** — ' || rd.channel || ', ' || CAST(upload_date AS VARCHAR)
    || ' — `summary/' || rd.channel || '/Doc ' || doc_id || '.md`'] FROM rd JOIN cand USING (doc_id)""",
    "SELECT 10, '', 0, ['', '_No phrases met the document-frequency threshold._'] FROM phrases HAVING count(*) = 0",
)


@query("research_digest", _DIGEST)
def research_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of a full run against the run of three weeks before, written as text and read back."""
    import datetime as dt

    before = dt.date(2024, 2, 9)
    found = materialize(tfidf.entries(reports.theme_weights(_docs(spark, sf_dir, before), "doc_id")), "themes")
    terms, phrases = tfidf.top_terms(found, reports.TOP_TERMS), tfidf.top_phrases(found, reports.TOP_PHRASES, reports.MIN_DOCUMENTS)
    summary = F.concat(F.lit("summary/"), "channel", F.lit("/"), "title", F.lit(".md"))
    docs = _docs(spark, sf_dir).withColumn("summary_md", summary)
    parts = reports.build_digest(views.corpus(spark, sf_dir), docs, "doc_id", views.REFERENCE, reports.Previous(before.isoformat(), terms, phrases))
    return _written(spark, parts["digest"], "digest")


# --- index joins --------------------------------------------------------------

_ID = "CASE WHEN doc_id % 10 = 9 THEN NULL ELSE 'v' || (doc_id - doc_id % 3) END"
_INDEX = f"""tr AS (SELECT 'clean/' || channel || '/Doc ' || doc_id || '.txt' AS path, channel, {_ID} AS video_id, 'Doc ' || doc_id AS stem,
    doc_id, text FROM corpus),
cnt AS (SELECT channel, video_id, count(*) AS n, min(doc_id) AS only_doc FROM
    (SELECT channel, 'v' || (doc_id - doc_id % 3) AS video_id, doc_id FROM corpus WHERE doc_id % 37 <> 5) GROUP BY ALL),
meta AS (SELECT channel, doc_id, 'Doc ' || doc_id AS stem, 'v' || (doc_id - doc_id % 3) AS video_id FROM corpus WHERE doc_id % 37 <> 5),
m AS (SELECT tr.*, CASE
    WHEN tr.video_id IS NULL THEN (CASE WHEN s.doc_id IS NULL THEN 'missing' ELSE 'stem_only' END)
    WHEN c.n IS NULL THEN 'missing' WHEN c.n = 1 THEN 'by_id' WHEN s.doc_id IS NOT NULL THEN 'by_stem' ELSE 'ambiguous' END AS status,
    CASE WHEN tr.video_id IS NULL THEN s.doc_id WHEN c.n = 1 THEN c.only_doc ELSE s.doc_id END AS meta_doc
  FROM tr LEFT JOIN cnt c ON c.channel = tr.channel AND c.video_id = tr.video_id
  LEFT JOIN meta s ON s.channel = tr.channel AND s.stem = tr.stem)"""


def _index_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """File-like inputs of the index: neighbouring documents share a video id
    (copies), every tenth transcript has none, some metadata is missing."""
    docs = views.corpus(spark, sf_dir)
    d = F.col("doc_id")
    vid = F.concat(F.lit("v"), (d - d % 3).cast("string"))
    stem = F.concat(F.lit("Doc "), d.cast("string"))

    def path(kind: str, ext: str):
        return F.concat(F.lit(kind + "/"), F.col("channel"), F.lit("/"), stem, F.lit(ext))

    # every eleventh transcript has no cue file, and every eleventh one has a file without entries
    cues = views.table(spark, sf_dir, "documents").where(d % 11 != 4).select(
        F.concat(F.lit("clean/"), F.col("source"), F.lit("/"), stem, F.lit(".srt")).alias("path"),
        F.when(d % 11 != 5, F.col("n_chars") * 70).alias("last_end_ms"),
    )
    return {
        "transcripts": docs.select(
            path("clean", ".txt").alias("path"), "channel", F.when(d % 10 != 9, vid).alias("video_id"), stem.alias("stem"), "text"
        ),
        "metadata": docs.where(d % 37 != 5).select(
            "channel", vid.alias("video_id"), stem.alias("stem"), path("meta", ".info.json").alias("path"), "title", "upload_date"
        ),
        "summaries": docs.where("has_summary").select(
            "channel", vid.alias("video_id"), stem.alias("stem"), path("summary", ".md").alias("path"), "text"
        ),
        "cue_ends": cues,
        "channels": views.channel_dim(spark, sf_dir),
    }


@query(
    "metadata_match",
    with_(CORPUS, _INDEX) + """SELECT path, status AS metadata_path_status,
  CASE WHEN meta_doc IS NOT NULL THEN 'meta/' || channel || '/Doc ' || meta_doc || '.info.json' END AS metadata_path FROM m""",
)
def metadata_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = _index_inputs(spark, sf_dir)
    out = M.match_by_id_then_stem(
        inputs["transcripts"].drop("text"), inputs["metadata"], ["channel", "video_id"], "stem", "path", "metadata_path"
    )
    return out.select("path", "metadata_path_status", "metadata_path")


@query(
    "corpus_index",
    with_(
        CORPUS, CHANNELS, _INDEX,
        """sm AS (SELECT channel, doc_id, 'Doc ' || doc_id AS stem, 'v' || (doc_id - doc_id % 3) AS video_id, text FROM corpus WHERE has_summary)""",
        "sc AS (SELECT channel, video_id, count(*) AS n, min(doc_id) AS only_doc FROM sm GROUP BY ALL)",
        """s AS (SELECT m.path, CASE WHEN m.video_id IS NULL THEN e.doc_id WHEN c.n = 1 THEN c.only_doc ELSE e.doc_id END AS sum_doc
  FROM m LEFT JOIN sc c ON c.channel = m.channel AND c.video_id = m.video_id
  LEFT JOIN sm e ON e.channel = m.channel AND e.stem = m.stem)""",
        f"z AS (SELECT doc_id, {markdown('text')} AS norm FROM sm)",
    ) + f"""SELECT m.path, m.channel, coalesce(m.video_id, 'v' || (md.doc_id - md.doc_id % 3)) AS video_id, md.title,
  CAST(md.upload_date AS VARCHAR) AS upload_date, CASE WHEN d.doc_id % 11 NOT IN (4, 5) THEN CAST(floor(d.n_chars * 70 / 1000) AS BIGINT) END AS duration_seconds,
  CASE WHEN d.doc_id % 11 <> 4 THEN 'clean/' || m.channel || '/Doc ' || d.doc_id || '.srt' END AS cleaned_srt,
  {n_words('m.text')} AS word_count, coalesce(z.norm, '') <> '' AS has_summary,
  CASE WHEN z.norm <> '' THEN 'summary/' || m.channel || '/Doc ' || s.sum_doc || '.md' END AS summary_md,
  CASE WHEN z.norm <> '' THEN {n_words('z.norm')} END AS summary_words, ch.language, ch.category,
  CASE WHEN ch.channel IS NULL THEN 'unknown channel' WHEN m.meta_doc IS NULL THEN 'metadata ' || m.status END AS problem
  FROM m JOIN s ON s.path = m.path LEFT JOIN z ON z.doc_id = s.sum_doc LEFT JOIN corpus md ON md.doc_id = m.meta_doc
  JOIN documents d ON d.doc_id = m.doc_id LEFT JOIN channel_dim ch ON ch.channel = m.channel""",
)
def corpus_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = C.build_index(**_index_inputs(spark, sf_dir))
    return index.orderBy(*C.index_order()).select(
        "path", "channel", "video_id", "title", F.col("upload_date").cast("string").alias("upload_date"), "duration_seconds",
        "paths.cleaned_srt", "word_count", "has_summary", "paths.summary_md", F.col("summary_stats.word_count").alias("summary_words"),
        "channel_meta.language", "channel_meta.category", "problem",
    )


_NOT_NAME = r"[^\p{L}\p{N}_" + T._WS_CHARS + "-]"
_NAME_GAP = "[-" + T._WS_CHARS + "]+"


@query(
    "channel_name_collisions",
    f"""SELECT key, count(*) AS n, min(name) AS first_name, max(name) AS last_name FROM
  (SELECT name, regexp_replace({rep(rep('name', _NOT_NAME), _NAME_GAP, '_')}, '^_+|_+$', '', 'g') AS key
   FROM (SELECT DISTINCT unnest([source || ' - ' || lang, source || '_' || lang || '!']) AS name FROM documents)) GROUP BY key HAVING count(*) > 1""",
)
def channel_name_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents")
    spaced = F.concat(F.col("source"), F.lit(" - "), F.col("lang"))
    marked = F.concat(F.col("source"), F.lit("_"), F.col("lang"), F.lit("!"))
    names = docs.select(F.explode(F.array(spaced, marked)).alias("name")).distinct()
    return M.duplicate_keys(names, T.safe_channel_name("name"), "name")


@query(
    "pending_summaries",
    with_(CORPUS, "p AS (SELECT channel, doc_id FROM corpus WHERE NOT has_summary AND " + strip("text") + " <> '')") + """SELECT p.channel, doc_id, n AS channel_pending FROM p JOIN (SELECT channel, count(*) AS n FROM p GROUP BY channel) USING (channel)""",
)
def pending_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.corpus(spark, sf_dir)
    todo = M.pending(docs.drop("has_summary"), docs.where("has_summary"), ["doc_id"]).where(strip_ws("text") != "")
    return I.pending_order(todo.select("channel", "doc_id"), ["doc_id"]).select("channel", "doc_id", "channel_pending")


@query(
    "pending_counts",
    with_(CORPUS) + f"""SELECT count(*) AS files, count(*) FILTER (has_summary) AS done,
  count(*) FILTER (NOT has_summary AND {strip('text')} = '') AS empty, count(*) FILTER (NOT has_summary AND {strip('text')} <> '') AS pending FROM corpus""",
)
def pending_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = strip_ws("text") == ""
    done = F.col("has_summary")
    return views.corpus(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(done).alias("done"),
        F.count_if(~done & blank).alias("empty"), F.count_if(~done & ~blank).alias("pending"),
    )


@query(
    "pending_limited",
    with_(CORPUS, "lim AS (SELECT channel, CASE WHEN CAST(substr(channel, 4) AS INTEGER) % 3 = 0 THEN -1 ELSE CAST(substr(channel, 4) AS INTEGER) % 5 END AS cap FROM (SELECT DISTINCT channel FROM corpus))") + """
  SELECT channel, doc_id FROM (SELECT c.channel, c.doc_id, cap, row_number() OVER (PARTITION BY c.channel ORDER BY doc_id) AS r
    FROM corpus c JOIN lim USING (channel) WHERE NOT has_summary) WHERE cap = -1 OR r <= cap ORDER BY channel, doc_id LIMIT 100""",
)
def pending_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-channel limits (0 none, -1 all), then the run limit of 100."""
    docs = views.corpus(spark, sf_dir)
    n = F.substring("channel", 4, 10).cast("int")
    limits = docs.select("channel").distinct().withColumn("item_limit", F.when(n % 3 == 0, F.lit(-1)).otherwise(n % 5))
    todo = docs.where("not has_summary").select("channel", "doc_id")
    return I.limited_per_channel(todo, limits, ["doc_id"], run_limit=100)


@query(
    "video_metadata",
    """SELECT doc_id, CASE WHEN r IS NULL THEN 'Doc ' || doc_id END AS title,
  CASE WHEN r IS NULL AND doc_id % 23 <> 6 THEN CAST(DATE '2023-12-01' + CAST(doc_id % 90 AS INTEGER) AS VARCHAR) END AS upload_date, r AS reason
  FROM (SELECT doc_id, CASE doc_id % 23 WHEN 1 THEN 'title' WHEN 2 THEN 'upload_date calendar' WHEN 3 THEN 'upload_date shape'
    WHEN 4 THEN 'description' WHEN 5 THEN 'invalid JSON' WHEN 7 THEN 'upload_date type' WHEN 8 THEN 'id' END AS r FROM documents)""",
)
def video_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict metadata fields with the first broken rule."""
    d = F.col("doc_id")
    day = F.date_format(F.date_add(F.lit(views.FIRST_DAY), (d % 90).cast("int")), "yyyyMMdd")
    title = F.when(d % 23 == 1, F.lit("")).otherwise(F.concat(F.lit("Doc "), d.cast("string")))
    date = (
        F.when(d % 23 == 2, F.lit('"20251332"')).when(d % 23 == 3, F.lit('"2025119"')).when(d % 23 == 6, F.lit("null"))
        .when(d % 23 == 7, F.lit("20240101")).otherwise(F.concat(F.lit('"'), day, F.lit('"')))
    )
    description = F.when(d % 23 == 4, F.lit("7")).otherwise(F.lit('"text"'))
    ident = F.when(d % 23 == 8, F.lit('""')).otherwise(F.concat(F.lit('"v'), d.cast("string"), F.lit('"')))
    body = F.concat(
        F.lit('{"title": "'), title, F.lit('", "upload_date": '), date, F.lit(', "description": '), description,
        F.lit(', "id": '), ident, F.when(d % 23 == 5, F.lit("")).otherwise(F.lit("}")),
    )
    parsed = P.parse_video_metadata(views.table(spark, sf_dir, "documents").select("doc_id", body.alias("payload")))
    return parsed.select("doc_id", "title", F.col("upload_date").cast("string").alias("upload_date"), "reason")


@query(
    "compact_dates",
    """SELECT doc_id, CAST(try_strptime(v, '%Y%m%d') AS DATE)::VARCHAR AS day FROM
  (SELECT doc_id, (20240000 + (doc_id % 14) * 100 + doc_id % 34)::VARCHAR AS v FROM documents)""",
)
def compact_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    value = (F.lit(20240000) + (d % 14) * 100 + d % 34).cast("string")
    return views.table(spark, sf_dir, "documents").select("doc_id", compact_date(value).cast("string").alias("day"))

