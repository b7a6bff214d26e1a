"""Queries over URL inbox lines and raw items (pages)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import url_queue as Q
from ..plans import views
from ..session import materialize, scratch_dir
from ..sources import files, writers
from .base import query, quoted, rows_of
from .sqltext import collapse, lit, rep, strip, with_

_INBOX = """inbox AS (SELECT page_id * 2 + c AS position, CASE page_id % 17
    WHEN 5 THEN 'ftp://host' || page_id || '.org/x' WHEN 6 THEN 'not a url' WHEN 7 THEN 'plainword'
    WHEN 8 THEN 'https://arxiv.org/abs/2301.' || page_id WHEN 9 THEN 'www.Example.org:8080/Paper' || page_id || '.PDF#p2'
    WHEN 10 THEN 'http://user@HOST.net:99999/' || page_id WHEN 11 THEN 'https://www.youtube.com/watch?v=' || page_id
    WHEN 12 THEN 'https://docs.site.org/a.' || page_id || '.md' WHEN 13 THEN 'https://docs.site.org/a_' || (page_id - 1) || '_md'
    WHEN 14 THEN 'https://long.site.org/' || repeat('part-', 60) || page_id
    ELSE CASE WHEN page_id % 3 = 0 THEN 'cat->sub:' || url ELSE url END END AS line
  FROM (SELECT page_id, url, unnest(CASE WHEN page_id % 4 = 0 THEN [0, 1] ELSE [0] END) AS c FROM pages))"""


def _g(x: str, i: int) -> str:
    return f"regexp_extract({x}, {lit(U.PARTS)}, {i})"


def _canon(src: str, line: str, prefix: str = "") -> list[str]:
    p = prefix
    embedded = (
        f"CASE WHEN starts_with({line}, 'http') THEN {line} WHEN contains({line}, ':http') "
        f"THEN 'http' || substr({line}, position(':http' IN {line}) + 5) ELSE {line} END"
    )
    port = "TRY_CAST(port AS INTEGER)"
    arxiv = "host IN ('arxiv.org', 'www.arxiv.org')"
    return [
        f"{p}c1 AS (SELECT *, {strip(embedded)} AS u FROM {src})",
        f"{p}c2 AS (SELECT *, CASE WHEN regexp_matches(u, {lit(U.SCHEME)}) THEN u ELSE 'http://' || u END AS f FROM {p}c1)",
        f"""{p}c3 AS (SELECT *, lower({_g('f', 1)}) AS scheme, CASE WHEN {_g('f', 2)} = '//' THEN {rep(_g('f', 3), '^.*@')} ELSE '' END AS server,
  CASE WHEN {_g('f', 2)} = '//' THEN {_g('f', 4)} ELSE {_g('f', 3)} || {_g('f', 4)} END AS path, {_g('f', 6)} AS qry FROM {p}c2)""",
        f"{p}c4 AS (SELECT *, lower(split_part(server, ':', 1)) AS host, split_part(server, ':', 2) AS port FROM {p}c3)",
        f"""{p}c5 AS (SELECT *, CASE WHEN u = '' THEN 'empty URL' WHEN regexp_matches(u, '\\s') THEN 'URL contains whitespace'
  WHEN scheme NOT IN ('http', 'https') THEN 'unsupported URL scheme: ' || scheme WHEN host = '' THEN 'URL is missing a host'
  WHEN host <> 'localhost' AND NOT contains(host, '.') THEN 'URL host is not valid'
  WHEN port <> '' AND (NOT regexp_matches(port, '^[0-9]+$') OR coalesce({port}, 99999) > 65535) THEN 'URL port is not valid' END AS reason FROM {p}c4)""",
        f"""{p}canon AS (SELECT * EXCLUDE (u, f, scheme, server, path, qry, host, port), CASE WHEN reason IS NULL THEN scheme || '://' ||
  CASE WHEN {arxiv} THEN 'arxiv.org' WHEN port = '' THEN host ELSE host || ':' || {port} END ||
  CASE WHEN {arxiv} AND (starts_with(path, '/abs/') OR (starts_with(path, '/pdf/') AND NOT ends_with(lower(path), '.pdf')))
    THEN '/pdf/' || rtrim(substr(path, 6), '/') || '.pdf' WHEN path = '/' THEN '' ELSE path END ||
  CASE WHEN qry = '' THEN '' ELSE '?' || qry END END AS normalized_url FROM {p}c5)""",
    ]


def _path(u: str) -> str:
    return f"lower(regexp_extract({u}, '^https?://[^/?#]*([^?#]*)', 1))"


def _host(u: str) -> str:
    return f"regexp_extract({u}, '^https?://(?:www\\.)?([^/?#:]*)', 1)"


def _type(u: str) -> str:
    p = _path(u)
    return f"""CASE WHEN {_host(u)} IN ({quoted(U.UNSUPPORTED_HOSTS)}) THEN 'unknown' WHEN ends_with({p}, '.pdf') THEN 'pdf'
  WHEN ends_with({p}, '.html') OR ends_with({p}, '.htm') THEN 'html' WHEN ends_with({p}, '.md') THEN 'markdown'
  WHEN ends_with({p}, '.txt') THEN 'text' WHEN regexp_extract({p}, '\\.([^./]*)$', 1) IN ({quoted(U.NON_DOCUMENT_SUFFIXES)}) THEN 'unknown' ELSE 'html' END"""


def _stem(u: str) -> str:
    s = rep(rep(rep(f"replace({u}, '://', '__')", "[^A-Za-z0-9_-]", "_"), "_+", "_"), "^_+|_+$")
    return f"""CASE WHEN strlen({s}) <= 240 THEN {s} ELSE rtrim(substr({s}, 1, 223), '_') || '_' || substr(sha256({u}), 1, 16) END"""


_CANON = [_INBOX, *_canon("inbox", "line")]
_UNIQUE = [
    *_CANON,
    "u0 AS (SELECT normalized_url, arg_min(line, position) AS source_line, count(*) AS n_lines FROM canon WHERE normalized_url IS NOT NULL GROUP BY 1)",
    f"urls AS (SELECT *, {_stem('normalized_url')} AS stem, {_type('normalized_url')} AS content_type FROM u0)",
    "coll AS (SELECT stem, count(*) AS n_urls FROM urls GROUP BY stem HAVING count(*) > 1)",
]


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.canonical_lines(views.inbox(spark, sf_dir))


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.unique_urls(_canonical(spark, sf_dir))


@query("url_canonical", with_(*_CANON) + "SELECT position, line, normalized_url, reason FROM canon")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(spark, sf_dir)


@query("url_unique", with_(*_UNIQUE) + "SELECT normalized_url, source_line, n_lines FROM urls")
def url_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unique(spark, sf_dir).select("normalized_url", "source_line", "n_lines")


@query("url_types", with_(*_UNIQUE) + "SELECT normalized_url, content_type FROM urls")
def url_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unique(spark, sf_dir).select("normalized_url", "content_type")


@query("url_stems", with_(*_UNIQUE) + "SELECT normalized_url, stem FROM urls")
def url_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unique(spark, sf_dir).select("normalized_url", "stem")


@query(
    "url_stem_collisions",
    with_(*_UNIQUE) + "SELECT source_line, 'sanitized URL stem collision: ' || stem AS reason FROM urls JOIN coll USING (stem)",
)
def url_stem_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.collision_failures(_unique(spark, sf_dir))


@query(
    "url_queue_stats",
    with_(*_CANON) + """SELECT count(*) AS lines_read, count(DISTINCT normalized_url) AS unique_urls,
  count(normalized_url) - count(DISTINCT normalized_url) AS duplicate_entries, count(reason) AS unprocessable FROM canon""",
)
def url_queue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.queue_stats(_canonical(spark, sf_dir))


@query(
    "url_type_counts",
    with_(*_UNIQUE) + f"""SELECT t.content_type, count(u.stem) AS n FROM (VALUES {rows_of(U.CONTENT_TYPES)}) t(content_type)
  LEFT JOIN (SELECT * FROM urls WHERE stem NOT IN (SELECT stem FROM coll)) u USING (content_type) GROUP BY 1""",
)
def url_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.type_counts(Q.queued(_unique(spark, sf_dir)))


_OUTPUTS = f"""outs AS (SELECT {_stem('normalized_url')} AS stem, {_type('normalized_url')} AS content_type,
  CASE WHEN position % 10 = 4 THEN 0 ELSE 1 END AS size FROM canon WHERE normalized_url IS NOT NULL AND regexp_matches(normalized_url, '/(en|es)/'))"""


def _outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw outputs: the English and Spanish pages are there, some empty."""
    done = _canonical(spark, sf_dir).where(F.col("normalized_url").rlike("/(en|es)/"))
    url = F.col("normalized_url")
    size = F.when(F.col("position") % 10 == 4, F.lit(0)).otherwise(F.lit(1))
    return done.select(U.file_stem(url).alias("stem"), U.content_type(url).alias("content_type"), size.alias("size"))


@query(
    "url_pending_downloads",
    with_(*_UNIQUE, _OUTPUTS) + """SELECT normalized_url FROM urls u WHERE stem NOT IN (SELECT stem FROM coll)
  AND NOT EXISTS (SELECT 1 FROM outs o WHERE o.size > 0 AND o.stem = u.stem AND o.content_type = u.content_type)""",
)
def url_pending_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.not_downloaded(Q.queued(_unique(spark, sf_dir)), _outputs(spark, sf_dir)).select("normalized_url")


_STATUS = """stat AS (SELECT DISTINCT normalized_url FROM canon WHERE normalized_url IS NOT NULL AND
  (contains(normalized_url, 'spam') OR contains(normalized_url, '/fr/')))"""
_OUTCOMES = [
    *_CANON, _OUTPUTS, _STATUS,
    f"o1 AS (SELECT position, line, normalized_url, {_stem('normalized_url')} AS stem, {_type('normalized_url')} AS content_type FROM canon)",
    """o2 AS (SELECT o.*, CASE WHEN normalized_url IS NULL THEN 'unprocessable' WHEN content_type = 'unknown' THEN 'unsupported'
  WHEN EXISTS (SELECT 1 FROM outs x WHERE x.size > 0 AND x.stem = o.stem AND x.content_type = o.content_type) THEN 'already_downloaded'
  WHEN normalized_url IN (SELECT normalized_url FROM stat) THEN 'unreachable' END AS early FROM o1 o)""",
    """outc AS (SELECT *, coalesce(early, CASE WHEN row_number() OVER (PARTITION BY normalized_url, early IS NULL ORDER BY position) = 1
  THEN 'recoverable' ELSE 'duplicate' END) AS outcome FROM o2)""",
]


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = views.inbox(spark, sf_dir).withColumn("line", F.concat("line", F.lit("\treason")))
    url = F.col("normalized_url")
    status = _canonical(spark, sf_dir).where("normalized_url is not null").select(
        "normalized_url",
        F.when(F.contains(url, F.lit("spam")), "404").otherwise("200").alias("http_status"),
        F.when(F.contains(url, F.lit("/fr/")), "Could not resolve host: x").alias("error"),
    )
    return Q.requeue_outcomes(archive, _outputs(spark, sf_dir), status)


@query("requeue_waterfall", with_(*_OUTCOMES) + "SELECT outcome, count(*) AS n FROM outc GROUP BY 1")
def requeue_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.outcome_counts(_outcomes(spark, sf_dir))


@query(
    "requeue_candidates",
    with_(*_OUTCOMES) + """SELECT normalized_url, line AS source_line, content_type FROM outc WHERE outcome = 'recoverable'
  ORDER BY normalized_url LIMIT 20 OFFSET 5""",
)
def requeue_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.requeue_candidates(_outcomes(spark, sf_dir), limit=20, offset=5)


@query(
    "archive_lines",
    with_(*_UNIQUE) + f"""SELECT '2024-03-01' AS day, 'done' AS kind, source_line AS line FROM urls
  UNION ALL SELECT '2024-03-01', 'unprocessed', {collapse('line')} || chr(9) || {collapse('reason')} FROM canon WHERE reason IS NOT NULL""",
)
def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the day's outcomes to the archive and read it back."""
    rows = Q.archive_lines(
        _unique(spark, sf_dir).withColumn("day", F.lit("2024-03-01")),
        _canonical(spark, sf_dir).where("reason is not null").select(
            F.lit("2024-03-01").alias("day"), F.col("line").alias("source_line"), "reason"
        ),
    )
    path = scratch_dir(spark, "archive")
    writers.append_archive(rows, path)
    back = spark.read.schema("value string, kind string, day string").text(path)
    return back.select("day", "kind", F.col("value").alias("line"))


@query(
    "unseen_links",
    "SELECT DISTINCT url AS link FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE contains(url, '/en/'))",
)
def unseen_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = views.table(spark, sf_dir, "pages").select(F.col("url").alias("link"))
    seen = links.where(F.contains("link", F.lit("/en/")))
    return Q.unseen(links, seen).distinct()


@query("seen_links_after", "SELECT DISTINCT url AS link FROM pages")
def seen_links_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = views.table(spark, sf_dir, "pages").select(F.col("url").alias("link"))
    seen = links.where(F.contains("link", F.lit("/en/")))
    return Q.seen_after(seen, Q.unseen(links, seen))


def _stored_inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a written inbox: several files, blank padding, and a done folder that is not read."""
    root = scratch_dir(spark, "inbox")
    lines = views.inbox(spark, sf_dir).repartitionByRange("position").sortWithinPartitions("position").select("line")
    padded = F.explode(F.array(F.concat(F.lit("  "), "line", F.lit("\t")), F.lit("   "))).alias("value")
    lines.select(padded).write.option("maxRecordsPerFile", 1000).text(root)
    lines.write.text(root + "/done")
    return files.inbox_lines(spark, root)


@query(
    "inbox_files",
    with_(_INBOX) + f"SELECT {strip('line')} AS line, 2 * row_number() OVER (ORDER BY position) - 1 AS position FROM inbox QUALIFY line <> ''",
)
def inbox_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inbox lines of files with their places."""
    return _stored_inbox(spark, sf_dir).select("line", "position")


@query("inbox_queue", with_(*_UNIQUE) + f"SELECT normalized_url, {strip('source_line')} AS source_line, n_lines, stem, content_type FROM urls")
def inbox_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of the inbox files with the first line that names each."""
    found = Q.unique_urls(Q.canonical_lines(_stored_inbox(spark, sf_dir)))
    return found.select("normalized_url", "source_line", "n_lines", "stem", "content_type")


_LISTS = """lists AS (SELECT position // 40 AS file, bool_or(position % 97 = 3) AS changed FROM inbox GROUP BY 1)"""


@query("inbox_consumable", with_(_INBOX, _LISTS) + "SELECT 'list' || file || '.txt' AS name FROM lists WHERE NOT changed AND file % 10 <> 3")
def inbox_consumable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written inbox files whose content did not change since the snapshot; files that came after it are left alone."""
    root = scratch_dir(spark, "inbox")
    place = F.col("position")
    lines = views.inbox(spark, sf_dir).withColumn("file", F.floor(place / 40)).withColumn("late", place % 97 == 3)
    # 20 pages give at most 40 lines
    later = F.when(F.col("late"), F.concat("line", F.lit("#later"))).otherwise(F.col("line"))
    bodies = lines.groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("position", "line"))).alias("then"),
        F.array_sort(F.collect_list(F.struct("position", later.alias("line")))).alias("now"),
    )
    named = bodies.select(
        "file", F.concat(F.lit("list"), F.col("file").cast("string"), F.lit(".txt")).alias("name"),
        *[F.concat(F.array_join(F.transform(c, lambda x: x["line"]), "\n"), F.lit("\n")).alias(c) for c in ("then", "now")],
    )
    named = materialize(named, "inbox-files")
    writers.write_named(named.where("file % 10 <> 3"), "name", "then", root)
    snapshot = materialize(files.inbox_snapshot(spark, root), "inbox-snapshot")
    writers.write_named(named.where("then <> now OR file % 10 = 3"), "name", "now", root)
    left = Q.consumable(snapshot, files.inbox_snapshot(spark, root))
    return left.select(files.file_name(F.col("path")).alias("name"))
