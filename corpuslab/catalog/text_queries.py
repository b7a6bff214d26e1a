"""Queries over pages, keyword search, languages and token budgets."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import budget as B
from ..operators import language as L
from ..operators import pages as P
from ..operators import search as S
from ..plans import views
from ..session import materialize, scratch_dir
from ..sources import writers
from .base import query, quoted
from .sqltext import collapse, lit, n_words, rep, strip, with_, words

# --- pages --------------------------------------------------------------------

_NAME_MAP = f"map_from_entries([{', '.join(f'({lit(n)}, {lit(c)})' for n, c in html5.items() if n.endswith(';'))}])"
# named references with a semicolon, as the given pages have no others
_ENTITY = r"CASE WHEN i = 1 THEN p WHEN name_map[regexp_extract(p, '^[A-Za-z][A-Za-z0-9]{1,31};')] IS NOT NULL THEN name_map[regexp_extract(p, '^[A-Za-z][A-Za-z0-9]{1,31};')] || substr(p, length(regexp_extract(p, '^[A-Za-z][A-Za-z0-9]{1,31};')) + 1) ELSE '&' || p END"


def _page_lines(x: str) -> str:
    for pattern in P.DROPPED:
        x = rep(x, pattern, " ")
    x = rep(x, P.BLOCK_TAGS, "\n")
    x = rep(x, P.ANY_TAG, " ")
    decoded = f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: {_ENTITY}), '')"
    parts = f"regexp_split_to_array({decoded}, {lit(P.LINE_BREAK)})"
    return f"list_filter(list_transform({parts}, lambda x: {collapse('x')}), lambda x: x <> '')"


def _inside(x: str, tag: str) -> str:
    """Between the first opening tag and the first closing one behind it; the whole text without them."""
    low = f"lower({x})"
    start = f"(position('<{tag}' IN {low}) + position('>' IN substr({low}, position('<{tag}' IN {low}))))"
    return f"CASE WHEN contains({low}, '<{tag}') AND contains(substr({low}, {start}), '</{tag}>') THEN substr({x}, {start}, position('</{tag}>' IN substr({low}, {start})) - 1) ELSE {x} END"


_PAGES = f"""nm AS (SELECT {_NAME_MAP} AS name_map),
pg AS (SELECT page_id, {_page_lines("body")} AS lines FROM (SELECT page_id, {_inside("html", "body")} AS body FROM pages), nm)"""


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.extract_pages(views.table(spark, sf_dir, "pages"))


@query("page_text", with_(_PAGES) + "SELECT page_id, 'generic' AS family, array_to_string(lines, chr(10) || chr(10)) AS text FROM pg")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir).select("page_id", "family", "text")


_NEWS = """CASE WHEN contains(html, 'lang="en"') THEN replace(replace(html, '<article>', '<article class="newsletter-post"><div class="post-ufi"><div>Like</div><img src="x"> 12 <span>x<br/>y</span> likes</div>'),
  '</article>', '<p>Subscribe now</p><p>Over 10 readers</p></article><!-- substackcdn.com -->') ELSE html END"""


def _newsletters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English pages turned into newsletter posts with chrome around them."""
    html = F.replace(
        F.replace("html", F.lit("<article>"), F.lit('<article class="newsletter-post"><div class="post-ufi"><div>Like</div><img src="x"> 12 <span>x<br/>y</span> likes</div>')),
        F.lit("</article>"), F.lit("<p>Subscribe now</p><p>Over 10 readers</p></article><!-- substackcdn.com -->"),
    )
    rows = views.table(spark, sf_dir, "pages").select("page_id", "html")
    return rows.withColumn("html", F.when(F.contains("html", F.lit('lang="en"')), html).otherwise(F.col("html")))


@query(
    "page_families",
    with_(f"nl AS (SELECT page_id, {_NEWS} AS html FROM pages)") + """SELECT page_id, CASE WHEN contains(html, 'substackcdn.com')
  AND contains(html, '<article') AND contains(html, 'newsletter-post') THEN 'substack' ELSE 'generic' END AS family FROM nl""",
)
def page_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _newsletters(spark, sf_dir).select("page_id", P.page_family(F.col("html")).alias("family"))


_ARTICLE = "regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1)"
_IS_NEWS = "contains(html, 'newsletter-post') AND contains(html, 'substackcdn.com')"


@query(
    "newsletter_text",
    with_(
        f"nl AS (SELECT page_id, {_NEWS} AS html FROM pages)",
        f"nm AS (SELECT {_NAME_MAP} AS name_map)",
        f"""ex AS (SELECT page_id, html, {_IS_NEWS} AS news, {_page_lines("CASE WHEN " + _IS_NEWS + " THEN " + rep(_ARTICLE, '(?s)<div class="post-ufi">.*? likes</div>', ' ') +
        f" ELSE {_inside('html', 'body')} END")} AS lines FROM nl, nm)""",
    ) + f"""SELECT page_id, array_to_string(CASE WHEN news THEN list_filter(lines, lambda x: lower(x) NOT IN ({quoted(P.CHROME_LINES)})
    AND NOT ({" OR ".join(f"starts_with(lower(x), {lit(p)})" for p in P.CHROME_PREFIXES)})
    AND NOT (contains(lower(x), 'subscribers') AND len(string_split(x, ' ')) <= 4)) ELSE lines END, chr(10) || chr(10)) AS text FROM ex""",
)
def newsletter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.extract_pages(_newsletters(spark, sf_dir)).select("page_id", "text")


@query(
    "frequent_lines",
    with_(_PAGES) + "SELECT line, count(*) AS n_pages FROM (SELECT page_id, unnest(list_distinct(lines)) AS line FROM pg) GROUP BY 1 HAVING count(*) >= 3",
)
def frequent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.frequent_lines(_extracted(spark, sf_dir), "page_id", "lines", 3)


@query(
    "pages_without_boilerplate",
    with_(
        _PAGES,
        "ln AS (SELECT page_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS position FROM pg)",
        "fr AS (SELECT line FROM ln GROUP BY 1 HAVING count(DISTINCT page_id) >= 3)",
    ) + "SELECT page_id, position, line FROM ln WHERE line NOT IN (SELECT line FROM fr)",
)
def pages_without_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = materialize(_extracted(spark, sf_dir).select("page_id", "lines"), "page-lines")
    out = P.drop_frequent_lines(pages, "page_id", "lines", 3)
    return out.select("page_id", F.col("position").cast("long").alias("position"), "line")


_DECORATED = """CASE doc_id % 6 WHEN 0 THEN text || ' <div class="x">' WHEN 1 THEN text || ' `<b>` ' WHEN 2 THEN '```' || chr(10) || '<p>' || chr(10) || '```' || text
  WHEN 3 THEN '  ' WHEN 4 THEN text || ' a < b > c <custom>' ELSE text END"""


@query(
    "markdown_validation",
    f"""SELECT doc_id, CASE WHEN {collapse('md')} = '' THEN 'empty' WHEN len(list_filter(list_transform(regexp_extract_all(
    {rep(rep('md', '(?s)```.*?```'), '`[^`' + chr(10) + ']*`')}, '</?[ \\t\\r\\n]*([A-Za-z][-:A-Za-z0-9]*)(?:[ \\t\\r\\n/][^<>]*)?>', 1), lambda x: lower(x)), lambda x: x IN ({quoted(P.HTML_TAGS)}))) > 0
  THEN 'inline html' ELSE 'ok' END AS verdict FROM (SELECT doc_id, {_DECORATED} AS md FROM documents)""",
)
def markdown_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id") % 6
    md = (
        F.when(d == 0, F.concat("text", F.lit(' <div class="x">')))
        .when(d == 1, F.concat("text", F.lit(" `<b>` ")))
        .when(d == 2, F.concat(F.lit("```\n<p>\n```"), "text"))
        .when(d == 3, F.lit("  "))
        .when(d == 4, F.concat("text", F.lit(" a < b > c <custom>")))
        .otherwise(F.col("text"))
    )
    return views.table(spark, sf_dir, "documents").select("doc_id", P.markdown_verdict(md).alias("verdict"))


# --- string functions ---------------------------------------------------------


@query(
    "folder_titles",
    f"""SELECT doc_id, coalesce(nullif({rep(rep(rep('t', '[<>:"/\\\\|?*]', '_'), '_+', '_'), '^[. _]+|[. _]+$')}, ''), 'untitled') AS folder
  FROM (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN ' ._? ' ELSE lang || ': ' || source || '?/' || replace(text, chr(10), ' ') || '..' END AS t FROM documents)""",
)
def folder_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("doc_id") % 9 == 0, F.lit(" ._? ")).otherwise(
        F.concat("lang", F.lit(": "), "source", F.lit("?/"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(".."))
    )
    return views.table(spark, sf_dir, "documents").select("doc_id", T.safe_dirname(title).alias("folder"))


@query(
    "answers_after_reasoning",
    f"""SELECT conv_id, turn, CASE WHEN contains(t, '</think>') THEN {strip("substr(t, position('</think>' IN t) + 8)")} ELSE t END AS answer,
  CASE WHEN length(e) > 240 THEN substr(e, 1, 237) || '...' ELSE e END AS summary
  FROM (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN '<think>' || text || '</think>' || chr(10) || text || '</think>' ELSE text END AS t,
    'ValueError: ' || {collapse('text')} AS e FROM conversations)""",
)
def answers_after_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.concat(F.lit("<think>"), "text", F.lit("</think>\n"), "text", F.lit("</think>"))
    reply = F.when(F.col("role") == "assistant", wrapped).otherwise(F.col("text"))
    return views.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", T.after_think(reply).alias("answer"), T.error_summary(F.lit("ValueError"), "text").alias("summary")
    )


@query(
    "rendered_prompts",
    """SELECT doc_id, md5('Clean this:' || chr(10) || text || chr(10) || 'End ' || text) AS digest,
  CASE WHEN lang = 'en' THEN 'Video: ' || source || '. About: ' || coalesce(CASE WHEN doc_id % 5 > 0 THEN lang END, '') ELSE '' END AS speech FROM documents""",
)
def rendered_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = "Clean this:\n{source_text}\nEnd {source_text}"
    about = F.when(F.col("doc_id") % 5 > 0, F.col("lang"))
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(T.render_prompt(template, "source_text", "text")).alias("digest"),
        T.speech_prompt("lang", "source", about, "Video: {title}. About: {description}").alias("speech"),
    )


@query(
    "alphabetic_words",
    f"""SELECT doc_id, CASE WHEN {strip('t')} = '' THEN '' WHEN len(a) = 0 THEN '??' ELSE array_to_string(a, ' ') END AS kept
  FROM (SELECT doc_id, t, list_filter({words('t')}, lambda x: regexp_matches(x, '\\p{{L}}')) AS a FROM
  (SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN '12 34 - !' WHEN 1 THEN '   ' ELSE text || ' 42 --' END AS t FROM documents))""",
)
def alphabetic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id") % 8
    t = F.when(d == 0, F.lit("12 34 - !")).when(d == 1, F.lit("   ")).otherwise(F.concat("text", F.lit(" 42 --")))
    return views.table(spark, sf_dir, "documents").select("doc_id", T.alpha_words(t).alias("kept"))


# --- search -------------------------------------------------------------------

_LN = "ln AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)"


@query(
    "keyword_search",
    with_(_LN) + "SELECT source, doc_id, count(*) AS n_lines FROM ln WHERE regexp_matches(line, 'Th(at|e) [a-m]+ing') GROUP BY 1, 2",
)
def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.regex_ranking(views.table(spark, sf_dir, "documents"), ["source", "doc_id"], "text", "Th(at|e) [a-m]+ing")


@query(
    "line_hits",
    with_(_LN) + "SELECT source, doc_id, line_no, line FROM ln WHERE contains(line, 'licen') OR contains(line, 'http')",
)
def line_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    match = F.contains("line", F.lit("licen")) | F.contains("line", F.lit("http"))
    return S.line_hits(views.table(spark, sf_dir, "documents"), ["source", "doc_id"], "text", match)


_RESEARCH = """rs AS (SELECT 'transcripts' AS corpus, doc_id AS id, unnest(string_split(text, chr(10))) AS line FROM documents
  UNION ALL SELECT 'summaries', conv_id * 100 + turn, unnest(string_split(text, chr(10))) FROM conversations),
rk AS (SELECT corpus, id, count(*) AS n_lines FROM rs WHERE contains(lower(line), 'the the') OR contains(lower(line), 'é les') OR contains(lower(line), 'und') GROUP BY 1, 2)"""


def _research(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    talks = views.table(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), "text")
    return S.research({"transcripts": docs, "summaries": talks}, ["id"], "text", " The the, É LES ,, und")


@query("keyword_research", with_(_RESEARCH) + "SELECT *, row_number() OVER (PARTITION BY corpus ORDER BY n_lines DESC, id) AS rank FROM rk")
def keyword_research(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.research_ranks(materialize(_research(spark, sf_dir), "research"), "id")


@query("keyword_research_counts", with_(_RESEARCH) + "SELECT corpus, count(*) AS n_documents FROM rk GROUP BY 1")
def keyword_research_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.research_counts(_research(spark, sf_dir), ["transcripts", "summaries"])


# --- languages ----------------------------------------------------------------

_CHUNKS = f"""cw AS (SELECT doc_id, lang, source, text, {words('text')} AS w FROM documents),
cx AS (SELECT *, unnest(range(CAST(ceil(len(w) / 200.0) AS BIGINT))) AS chunk FROM cw WHERE len(w) > 0),
ch AS (SELECT doc_id, lang, source, chunk, CASE WHEN len(w) < 200 THEN {strip('text')}
  ELSE array_to_string(w[least(chunk * 200, len(w) - 200) + 1:least(chunk * 200, len(w) - 200) + 200], ' ') END AS chunk_text FROM cx)"""


def _chunks(spark: SparkSession, sf_dir: str, target: int = 200) -> DataFrame:
    return L.chunks(views.table(spark, sf_dir, "documents"), ["doc_id"], "text", target)


@query("language_chunks", with_(_CHUNKS) + "SELECT doc_id, chunk, md5(chunk_text) AS digest FROM ch")
def language_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select("doc_id", "chunk", F.md5("chunk_text").alias("digest"))


def _grams(src: str, keys: str, text: str, out: str) -> str:
    alpha = f"array_to_string(list_filter({words(text)}, lambda x: regexp_matches(x, '\\p{{L}}')), ' ')"
    return f"""{out}0 AS (SELECT {keys}, string_split(' ' || lower({alpha}) || ' ', '') AS c FROM {src} WHERE {alpha} <> ''),
{out}1 AS (SELECT {keys}, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM {out}0),
{out} AS (SELECT {keys}, gram, count(*) AS n FROM {out}1 GROUP BY ALL)"""


_MODEL = f"""{_grams('documents', 'lang', 'text', 'pg')},
top AS (SELECT DISTINCT gram FROM pg),
kept AS (SELECT * FROM pg),
lb AS (SELECT d.lang, ln(count(*)::DOUBLE / (SELECT count(*) FROM documents)) AS prior, (SELECT sum(n) FROM kept k WHERE k.lang = d.lang)::DOUBLE AS total
  FROM documents d GROUP BY d.lang),
model AS (SELECT lb.lang AS label, prior, top.gram, ln((coalesce(k.n, 0) + 1.0) / (total + (SELECT count(*) FROM top))) AS log_p
  FROM lb CROSS JOIN top LEFT JOIN kept k ON k.lang = lb.lang AND k.gram = top.gram)"""
_PRED = f"""{_grams('ch', 'doc_id, chunk', 'chunk_text', 'cg')},
sc AS (SELECT doc_id, chunk, label, sum(n * log_p) + max(prior) AS s FROM cg JOIN model USING (gram) GROUP BY 1, 2, 3),
bs AS (SELECT doc_id, chunk, arg_min(label, (-s, label)) AS predicted, max(s) AS m FROM sc GROUP BY 1, 2),
cf AS (SELECT sc.doc_id, sc.chunk, 1.0 / sum(exp(s - m)) AS confidence FROM sc JOIN bs USING (doc_id, chunk) GROUP BY 1, 2),
pred AS (SELECT ch.doc_id, ch.chunk, coalesce(predicted, '??') AS predicted, coalesce(confidence, 0.0) AS confidence
  FROM ch LEFT JOIN bs USING (doc_id, chunk) LEFT JOIN cf USING (doc_id, chunk)),
st AS (SELECT doc_id, chunk, CASE WHEN predicted NOT IN ('en', '??') AND confidence < 0.7 THEN 'en' ELSE predicted END AS l FROM pred),
prof AS (SELECT d.doc_id, source, {n_words('text')} AS word_count, coalesce(string_agg(DISTINCT l, ',' ORDER BY l), 'no_content') AS languages,
  count(l) AS n_chunks, coalesce(avg((l IN ('en', '??'))::INT), 1.0) >= 0.8 AS english_only FROM documents d LEFT JOIN st USING (doc_id) GROUP BY d.doc_id, source, text)"""


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents")
    return L.predict(_chunks(spark, sf_dir), ["doc_id", "chunk"], "chunk_text", L.train(docs, "lang", "text"))


@query(
    "language_model",
    with_(_MODEL) + "SELECT label, gram, round(prior, 6) AS prior, round(log_p, 6) AS log_p FROM model",
)
def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = L.train(views.table(spark, sf_dir, "documents"), "lang", "text")
    rows = model.select("gram", F.explode("per_label").alias("p"))
    return rows.select("p.label", "gram", F.round("p.prior", 6).alias("prior"), F.round("p.log_p", 6).alias("log_p"))


@query("language_predictions", with_(_CHUNKS, _MODEL, _PRED) + "SELECT doc_id, chunk, predicted, round(confidence, 6) AS confidence FROM pred")
def language_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(spark, sf_dir).withColumn("confidence", F.round("confidence", 6))


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents")
    found = L.file_profiles(docs, _predictions(spark, sf_dir), ["doc_id"], "text")
    return found.join(docs.select("doc_id", F.col("source").alias("channel")), "doc_id")


@query("language_profiles", with_(_CHUNKS, _MODEL, _PRED) + "SELECT doc_id, word_count, languages, n_chunks, english_only FROM prof")
def language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir).drop("channel")


@query(
    "language_channel_report",
    with_(_CHUNKS, _MODEL, _PRED) + """SELECT source AS channel, count(*) AS n_files, count(*) FILTER (english_only) AS n_english,
  CAST(sum(word_count) AS BIGINT) AS n_words, string_agg(DISTINCT languages, '; ' ORDER BY languages) AS profiles FROM prof GROUP BY 1""",
)
def language_channel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel reports, written one folder per channel and read back."""
    path = scratch_dir(spark, "languages")
    report = L.channel_report(_profiles(spark, sf_dir), "channel")
    writers.write_by_channel(report, path)
    return spark.read.schema(report.schema).json(path)


@query(
    "language_file_report",
    with_(_CHUNKS, _MODEL, _PRED) + """SELECT source AS channel, section, doc_id, languages, word_count FROM prof,
  (VALUES ('all files'), ('not English')) s(section) WHERE section = 'all files' OR NOT english_only""",
)
def language_file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per file and channel, and a section of the files that are not English, written by channel and read back."""
    path = scratch_dir(spark, "language-files")
    rows = L.file_rows(_profiles(spark, sf_dir), ["channel", "doc_id"])
    writers.write_by_channel(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query(
    "language_confusion",
    with_(_CHUNKS, _MODEL, _PRED) + "SELECT lang, predicted, count(*) AS n FROM pred JOIN documents USING (doc_id) GROUP BY 1, 2",
)
def language_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = views.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return _predictions(spark, sf_dir).join(gold, "doc_id").groupBy("lang", "predicted").agg(F.count(F.lit(1)).alias("n"))


# --- budgets ------------------------------------------------------------------

_TOK = f"tk AS (SELECT doc_id, source, text, n_chars, len(regexp_extract_all(text, {lit(T.TOKEN_PIECE)})) AS tokens FROM documents)"


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "documents").withColumn("tokens", T.estimated_tokens("text"))


@query("token_counts", with_(_TOK) + "SELECT doc_id, tokens FROM tk")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens(spark, sf_dir).select("doc_id", "tokens")


_WIDTH = """wd AS (SELECT min(w) AS width FROM (SELECT 1024 * CAST(2 ** g AS BIGINT) AS w FROM range(40) t(g))
  WHERE w * 32 >= (SELECT max(tokens) FROM tk))"""


@query(
    "token_histogram_totals",
    with_(_TOK, _WIDTH) + """SELECT count(*) AS n_files, CAST(sum(tokens) AS BIGINT) AS total_tokens, max(tokens) AS max_tokens,
  round(avg(tokens), 4) AS avg_tokens, (SELECT width FROM wd) AS bucket_width FROM tk""",
)
def token_histogram_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.histogram_totals(_tokens(spark, sf_dir).select("tokens"), "tokens")


def _histogram_sql(width: str) -> str:
    return f"""SELECT CASE WHEN s < 32 THEN s END AS bucket, s * {width} AS from_tokens, count(b) AS n_files FROM range(33) t(s)
  LEFT JOIN (SELECT CASE WHEN tokens > 32 * {width} THEN 32 ELSE least(tokens // {width}, 31) END AS b FROM tk) ON b = s GROUP BY s"""


@query("token_histogram", with_(_TOK, _WIDTH) + _histogram_sql("(SELECT width FROM wd)"))
def token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.histogram(_tokens(spark, sf_dir).select("tokens"), "tokens")


@query("token_histogram_fixed", with_(_TOK) + _histogram_sql("100"))
def token_histogram_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed width of 100 tokens, so large files overflow."""
    return B.histogram(_tokens(spark, sf_dir).select("tokens"), "tokens", width=100)


@query(
    "summary_plan",
    with_(_TOK) + f"""SELECT doc_id, tokens, verdict, CASE WHEN verdict = 'ok' THEN least(800, 2048 - tokens) END AS request_tokens FROM
  (SELECT doc_id, tokens, CASE WHEN {strip('text')} = '' THEN 'skip (empty)' WHEN tokens > 1228 OR 2048 - tokens <= 0 THEN 'skip (oversized)' ELSE 'ok' END AS verdict FROM tk)""",
)
def summary_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8192-token context shared by four workers, 60 % threshold."""
    context = B.worker_context(8192, 4)
    plan = B.summary_plan(_tokens(spark, sf_dir), "tokens", F.col("text"), context, 60, 800)
    return plan.select("doc_id", "tokens", "verdict", "request_tokens")


@query(
    "clean_gate",
    with_(_TOK) + """SELECT doc_id, CAST(700 AS BIGINT) AS token_limit, tokens > 700 AS oversized, CASE WHEN tokens > 700 THEN 'output window' END AS bound_by FROM tk""",
)
def clean_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = B.clean_gate(_tokens(spark, sf_dir), "tokens", 2048, 60, 700)
    return gate.select("doc_id", "token_limit", "oversized", "bound_by")


_GATE = """it AS (SELECT 'd' || doc_id AS raw_name, n_chars AS raw_bytes, tokens FROM tk),
un AS (SELECT raw_name, max(w) AS w FROM (SELECT 'd' || doc_id AS raw_name, 1000 AS w FROM labels WHERE toxic = 1
  UNION ALL SELECT 'd' || doc_id, quality * 500 FROM labels) GROUP BY 1),
ux AS (SELECT 'd' || l.doc_id AS raw_name, n_chars + l.doc_id % 2 AS b FROM labels l JOIN documents USING (doc_id) WHERE quality = 0),
gt AS (SELECT it.*, CASE WHEN 800 <= un.w THEN 'skip (uncleanable)' WHEN raw_bytes = ux.b THEN 'skip (unextractable)' ELSE 'process' END AS gate
  FROM it LEFT JOIN un USING (raw_name) LEFT JOIN ux USING (raw_name))"""


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items against the two failure registries, built from the labels."""
    labels = views.table(spark, sf_dir, "labels")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("raw_name")
    items = _tokens(spark, sf_dir).select(name, F.col("n_chars").alias("raw_bytes"), "tokens")
    recorded = labels.where("toxic = 1").select(name, F.lit(1000).cast("long").alias("failed_window"))
    fresh = labels.select(name, (F.col("quality") * 500).cast("long").alias("failed_window"))
    sizes = labels.where("quality = 0").join(views.table(spark, sf_dir, "documents"), "doc_id")
    broken = sizes.select(name, (F.col("n_chars") + F.col("doc_id") % 2).alias("raw_bytes"))
    return B.retry_gate(items, B.upsert_failed_windows(recorded, fresh), broken, 800)


@query("retry_gate", with_(_TOK, _GATE) + "SELECT raw_name, gate FROM gt")
def retry_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).select("raw_name", "gate")


@query("clean_run_summary", with_(_TOK, _GATE) + "SELECT gate, count(*) AS n FROM gt GROUP BY 1")
def clean_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.status_counts(_gated(spark, sf_dir), "gate")


@query(
    "work_estimate",
    with_(_TOK, _GATE) + """SELECT count(*) AS n_items, CAST(sum(raw_bytes) AS BIGINT) AS total_chars, CAST(sum(tokens) AS BIGINT) AS total_tokens
  FROM gt WHERE gate = 'process' AND tokens <= 600""",
)
def work_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = _gated(spark, sf_dir).where("gate = 'process'")
    return B.estimate_totals(B.estimate(todo, "tokens", 600), "raw_bytes", "tokens")


@query(
    "selected_items",
    with_(_TOK, _GATE) + """SELECT raw_name FROM gt WHERE gate = 'process' AND raw_name IN (SELECT 'd' || doc_id FROM labels WHERE quality = 1 AND toxic = 0)
  AND raw_name IN (SELECT raw_name FROM gt WHERE gate = 'process') ORDER BY raw_name LIMIT 25""",
)
def selected_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicitly wanted pending items, then the run limit."""
    todo = materialize(_gated(spark, sf_dir).where("gate = 'process'").select("raw_name"), "pending")
    good = views.table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    wanted = good.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("raw_name")).join(todo, "raw_name", "left_semi")
    return B.select_pending(todo, wanted, "raw_name", 25)



