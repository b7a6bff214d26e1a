"""Queries over timed cues, repetitions and intervals (conversations)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions import text as T
from ..functions.times import cue_time_ms, cue_time_text
from ..operators import cues as Q
from ..operators import intervals as V
from ..operators import repetition as R
from ..plans import views
from ..session import materialize, scratch_dir
from ..sources import files, writers
from .base import query
from .sqltext import prepare, strip, with_, words

_LOOP = f"""CASE WHEN (conv_id + turn) % 5 = 0 THEN text || repeat(' ' || array_to_string({words(prepare('text'))}[1:turn % 4 + 1], ' '), turn + 7)
  ELSE text END"""


def _cues(content: str = "text") -> list[str]:
    return [
        f"k0 AS (SELECT conv_id, turn, {content} AS content FROM conversations)",
        f"k1 AS (SELECT *, {words(prepare('content'))} AS words FROM k0)",
        "k2 AS (SELECT *, len(words) AS n_words, CAST(sum(len(words)) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS word_end FROM k1)",
        "cues AS (SELECT *, word_end - n_words AS word_start, (word_end - n_words) * 400 AS start_ms, word_end * 400 AS end_ms FROM k2)",
    ]


CUES = _cues()
LOOPED = _cues(_LOOP)


@query("cue_word_offsets", with_(*CUES) + "SELECT conv_id, turn, n_words, word_start, word_end, start_ms, end_ms FROM cues")
def cue_word_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cues(spark, sf_dir).select("conv_id", "turn", "n_words", "word_start", "word_end", "start_ms", "end_ms")


@query(
    "word_to_time",
    with_(
        *CUES,
        "pts AS (SELECT conv_id, turn, turn * 57 AS p FROM conversations UNION ALL SELECT DISTINCT -conv_id - 1, 0, 3 FROM conversations)",
        "ends AS (SELECT conv_id, max(end_ms) AS e FROM cues GROUP BY 1)",
    ) + """SELECT pts.conv_id, pts.turn, p, coalesce(c.start_ms, e, 0) AS time_ms FROM pts
  LEFT JOIN cues c ON c.conv_id = pts.conv_id AND c.word_start <= p AND p < c.word_end LEFT JOIN ends ON ends.conv_id = pts.conv_id""",
)
def word_to_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions inside, past the end, and of transcripts without cues."""
    rows = views.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    points = rows.withColumn("p", F.col("turn") * 57).unionByName(
        rows.select((-F.col("conv_id") - 1).alias("conv_id")).distinct().select(
            "conv_id", F.lit(0).cast("long").alias("turn"), F.lit(3).cast("long").alias("p")
        )
    )
    return Q.word_to_time(points, views.cues(spark, sf_dir), "conv_id", "turn", "p").select("conv_id", "turn", "p", "time_ms")


_LINES = f"""ls AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')) AS line,
  generate_subscripts(list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}), lambda x: x <> ''), 1) AS i FROM documents)"""


def _subtitle_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subtitle file per document, one cue per non-empty line."""
    lines = F.filter(F.transform(F.split("text", "\n"), T.strip_ws), lambda x: x != "")
    block = F.transform(
        lines,
        lambda x, i: F.concat(
            (i + 1).cast("string"), F.lit("\n"), cue_time_text(i.cast("long") * 2500), F.lit(" --> "),
            cue_time_text(i.cast("long") * 2500 + 2499), F.lit("\n"), x,
        ),
    )
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("channel"), F.array_join(block, "\n\n").alias("text")
    )


@query(
    "subtitle_cues",
    with_(_LINES) + "SELECT doc_id, i AS cue_index, (i - 1) * 2500 AS start_ms, (i - 1) * 2500 + 2499 AS end_ms, line AS content FROM ls",
)
def subtitle_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.parse_cues(_subtitle_files(spark, sf_dir).drop("channel"))


@query(
    "cue_plain_text",
    with_(_LINES) + "SELECT d.doc_id, string_agg(line, chr(10) ORDER BY i) AS plain_text, CASE WHEN count(line) = 0 THEN 'no cues found' END AS error FROM documents d LEFT JOIN ls USING (doc_id) GROUP BY 1",
)
def cue_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.plain_text_files(_subtitle_files(spark, sf_dir).drop("channel"), "text")


@query("cue_lines", f"SELECT conv_id, turn, {strip('text')} AS line FROM conversations WHERE {strip('text')} <> ''")
def cue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return Q.plain_lines(rows, "text").select("conv_id", "turn", "line")


@query(
    "transcript_hours",
    with_(_LINES, "e AS (SELECT doc_id, max(CAST(floor(((i - 1) * 2500 + 2499) / 1000) AS BIGINT)) AS s FROM ls GROUP BY 1)")
    + "SELECT source AS channel, count(*) AS n_files, CAST(sum(s) AS BIGINT) AS total_s FROM e JOIN documents USING (doc_id) GROUP BY 1",
)
def transcript_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.hours_by_channel(Q.parse_cues(_subtitle_files(spark, sf_dir)), "channel", "doc_id")


@query(
    "cue_times",
    """SELECT doc_id, lpad(CAST(ms // 3600000 AS VARCHAR), CAST(greatest(2, length(CAST(ms // 3600000 AS VARCHAR))) AS INTEGER), '0') || ':' ||
  lpad(CAST(ms // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(ms // 1000 % 60 AS VARCHAR), 2, '0') || ',' ||
  lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') AS label, ms AS back_ms FROM (SELECT doc_id, doc_id * n_chars * 371 AS ms FROM documents)""",
)
def cue_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = cue_time_text(F.col("doc_id") * F.col("n_chars") * 371)
    rows = views.table(spark, sf_dir, "documents").select("doc_id", label.alias("label"))
    return rows.withColumn("back_ms", cue_time_ms(F.replace("label", F.lit(","), F.lit("."))))


# --- repetition ---------------------------------------------------------------


def _runs_sql(src: str, keys: str, p: str = "") -> list[str]:
    """Brute force: every period k of every word array, gaps and islands; ``p`` goes before the names."""
    ks = ", ".join(f"a.{k}" for k in keys.split(", "))
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    score = "0.888846 * reps + 0.666538 * k - 6.777051"
    return [
        f"{p}wd AS (SELECT {keys}, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i, len(words) AS n FROM {src})",
        f"{p}eq AS (SELECT {ks}, a.i, b.i - a.i AS k FROM {p}wd a JOIN {p}wd b ON {on} AND a.w = b.w AND b.i > a.i AND b.i - a.i <= a.n // 5)",
        f"{p}isl AS (SELECT *, i - row_number() OVER (PARTITION BY {keys}, k ORDER BY i) AS g FROM {p}eq)",
        f"""{p}rn AS (SELECT {keys}, k, min(i) AS s, count(*) // k + 1 AS reps, min(i) + count(*) + k AS reach FROM {p}isl GROUP BY {keys}, k, g HAVING count(*) // k + 1 >= 5)""",
        f"""{p}pr AS (SELECT *, s + k * reps AS e FROM {p}rn r WHERE NOT EXISTS (SELECT 1 FROM {p}rn q WHERE
  {" AND ".join(f"q.{x} = r.{x}" for x in keys.split(", "))} AND q.k < r.k AND r.k % q.k = 0 AND q.s <= r.s AND q.s + q.k * q.reps + q.k > r.s + r.k))""",
        f"{p}hit AS (SELECT *, {score} AS score FROM {p}pr WHERE {score} > 0)",
        f"{p}h1 AS (SELECT * FROM {p}hit QUALIFY row_number() OVER (PARTITION BY {keys}, s ORDER BY k DESC) = 1)",
        f"""{p}h2 AS (SELECT * EXCLUDE (m) FROM (SELECT *, max(e) OVER (PARTITION BY {keys} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM {p}h1) WHERE m IS NULL OR e > m)""",
    ]


def _turn_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cues(spark, sf_dir, looped=True).select("conv_id", "turn", "words")


@query(
    "repetition_runs",
    with_(*LOOPED, *_runs_sql("cues", "conv_id, turn")) + "SELECT conv_id, turn, s AS start, k, reps AS repetitions, e AS run_end FROM pr",
)
def repetition_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least five repetitions inside each cue."""
    return R.repeated_runs(_turn_words(spark, sf_dir), "words").drop("words", "reach")


@query(
    "repetition_hits",
    with_(*LOOPED, *_runs_sql("cues", "conv_id, turn"))
    + "SELECT conv_id, turn, s AS start, k, reps AS repetitions, round(score::DOUBLE, 6) AS score FROM h2",
)
def repetition_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = R.classify(R.repeated_runs(_turn_words(spark, sf_dir), "words")).drop("words")
    return R.outermost(hits, ["conv_id", "turn"]).select(
        "conv_id", "turn", "start", "k", "repetitions", F.round("score", 6).alias("score")
    )


@query(
    "repetition_documents",
    with_(f"dw AS (SELECT doc_id, {words(prepare('text'))} AS words FROM documents)", *_runs_sql("dw", "doc_id"))
    + "SELECT doc_id, s AS start, k, reps AS repetitions, round(score::DOUBLE, 6) AS score FROM h2",
)
def repetition_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits in whole documents."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", T.words(T.prepare("text")).alias("words"))
    hits = R.classify(R.repeated_runs(docs, "words")).drop("words")
    return R.outermost(hits, ["doc_id"]).select("doc_id", "start", "k", "repetitions", F.round("score", 6).alias("score"))


@query(
    "repetition_training_rows",
    with_(*LOOPED, *_runs_sql("cues", "conv_id, turn")) + """SELECT c.conv_id * 1000 + c.turn AS cue_id, coalesce(max(reps) FILTER (r = 1), 0) AS repetitions,
  coalesce(max(k) FILTER (r = 1), 0) AS sequence_length, coalesce(max(k * reps) FILTER (r = 1), 0) AS area
  FROM cues c LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY k * reps DESC, s) AS r FROM h2) h
  ON h.conv_id = c.conv_id AND h.turn = c.turn GROUP BY 1""",
)
def repetition_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turn_words(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("cue_id"), "words")
    return R.training_rows(rows, "cue_id", "words")


_WINDOWS = [
    *LOOPED,
    """wp AS (SELECT conv_id, word_start + i - 1 AS p, w FROM (SELECT conv_id, word_start, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM cues))""",
    """wx AS (SELECT conv_id, p, w, unnest(range(greatest(0, (p - 500) // 375 - 1), p // 375 + 1)) AS window_id FROM wp)""",
    """win AS (SELECT conv_id, window_id, window_id * 375 AS window_start, list(w ORDER BY p) AS words FROM wx
  WHERE p >= window_id * 375 AND p < window_id * 375 + 500 GROUP BY 1, 2 HAVING window_id = 0 OR count(*) > 125)""",
]
_HITS = [*_WINDOWS, *_runs_sql("win", "conv_id, window_id"),
         "hits AS (SELECT *, window_id * 375 + s AS hit_start, window_id * 375 + e AS hit_end FROM h2)"]


def _looped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues with offsets, written once: the jobs below read them several times."""
    return materialize(views.cues(spark, sf_dir, looped=True), "cues")


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.word_windows(views.cues(spark, sf_dir, looped=True), "conv_id", "turn", "words")


@query(
    "word_windows",
    with_(*_WINDOWS) + "SELECT conv_id, window_id, window_start, len(words) AS n_words, md5(array_to_string(words, ' ')) AS digest FROM win",
)
def word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir).select(
        "conv_id", "window_id", "window_start", F.size("words").cast("long").alias("n_words"),
        F.md5(F.array_join("words", " ")).alias("digest"),
    )


_CUE_WINDOWS = [
    *LOOPED,
    "lst AS (SELECT conv_id, max(turn) AS z FROM cues GROUP BY 1)",
    """st AS (SELECT c.conv_id, c.turn, min(a.turn) AS a, min(a.word_start) AS s FROM cues c JOIN cues a ON a.conv_id = c.conv_id AND a.word_start >= c.word_end - 125 GROUP BY 1, 2)""",
    """nx AS (SELECT st.conv_id, st.turn, st.a, st.s, coalesce(min(e.turn), any_value(z)) AS nxt FROM st JOIN lst USING (conv_id)
  LEFT JOIN cues e ON e.conv_id = st.conv_id AND e.word_end >= st.s + 500 WHERE st.turn < z GROUP BY ALL)""",
    """fi AS (SELECT lst.conv_id, coalesce(min(e.turn), any_value(z)) AS turn FROM lst LEFT JOIN cues e ON e.conv_id = lst.conv_id AND e.word_end >= 500 GROUP BY 1)""",
    """ch AS (SELECT fi.conv_id, 0 AS n, (SELECT min(turn) FROM cues c WHERE c.conv_id = fi.conv_id) AS a, CAST(0 AS BIGINT) AS s, fi.turn FROM fi
  UNION ALL SELECT ch.conv_id, n + 1, nx.a, nx.s, nx.nxt FROM ch JOIN nx ON nx.conv_id = ch.conv_id AND nx.turn = ch.turn)""",
]


@query(
    "cue_windows",
    with_(*_CUE_WINDOWS).replace("WITH ", "WITH RECURSIVE ", 1) + """SELECT conv_id, CAST(n AS BIGINT) AS window_index, a AS cue_from, ch.turn AS cue_to, s AS window_start, word_end AS window_end
  FROM ch JOIN cues USING (conv_id, turn)""",
)
def cue_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of whole cues over the looped transcripts."""
    return Q.cue_windows(_looped(spark, sf_dir), "conv_id", "turn")


@query("window_hits", with_(*_HITS) + "SELECT conv_id, window_id, hit_start, hit_end, k, reps AS repetitions FROM hits")
def window_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = R.window_hits(_windows(spark, sf_dir), "conv_id")
    return hits.select("conv_id", "window_id", "hit_start", "hit_end", "k", "repetitions")


@query(
    "first_hit_per_window",
    with_(*_HITS) + """SELECT conv_id, window_id, hit_start, k FROM hits
  QUALIFY row_number() OVER (PARTITION BY conv_id, window_id ORDER BY s, k DESC) = 1""",
)
def first_hit_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = R.window_hits(_windows(spark, sf_dir), "conv_id")
    return R.first_hit(hits, ["conv_id", "window_id"]).select("conv_id", "window_id", "hit_start", "k")


_MERGED = [
    *LOOPED,
    """wp AS (SELECT conv_id, word_start + i - 1 AS p, w FROM (SELECT conv_id, word_start, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM cues))""",
    "tr AS (SELECT conv_id, list(w ORDER BY p) AS words FROM wp GROUP BY 1)",
    *_runs_sql("tr", "conv_id"),
    "m5 AS (SELECT conv_id, s AS hit_start, e AS hit_end, k, reps FROM hit QUALIFY row_number() OVER (PARTITION BY conv_id, s ORDER BY e DESC, k DESC) = 1)",
    """merged AS (SELECT * EXCLUDE (mx) FROM (SELECT *, max(hit_end) OVER (PARTITION BY conv_id ORDER BY hit_start
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM m5) WHERE mx IS NULL OR hit_start >= mx)""",
]


def _merged(cues: DataFrame) -> DataFrame:
    return R.transcript_hits(cues, "conv_id", "turn", "words")


@query("merged_hits", with_(*_MERGED) + "SELECT conv_id, hit_start, hit_end, k, reps AS repetitions FROM merged")
def merged_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(_looped(spark, sf_dir)).select("conv_id", "hit_start", "hit_end", "k", "repetitions")


_SPANS = """spans AS (SELECT h.conv_id, h.hit_start, min(c.turn) AS cue_from, max(c.turn) AS cue_to, min(c.start_ms) AS hit_start_ms,
  max(c.end_ms) AS hit_end_ms, count(*) AS n_cues,
  string_agg(c.content, ' ' ORDER BY c.turn) FILTER (c.word_start < h.hit_start + h.k) AS text FROM merged h JOIN cues c ON c.conv_id = h.conv_id AND c.word_start < h.hit_end AND h.hit_start < c.word_end
  GROUP BY 1, 2)"""


def _hit_spans(cues: DataFrame) -> DataFrame:
    return R.hit_cue_spans(_merged(cues), cues, "conv_id", "turn")


@query("hit_cue_spans", with_(*_MERGED, _SPANS) + "SELECT * FROM spans")
def hit_cue_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hit_spans(_looped(spark, sf_dir)).select("conv_id", "hit_start", "cue_from", "cue_to", "hit_start_ms", "hit_end_ms", "n_cues", "text")


@query(
    "cues_in_hits",
    with_(*_MERGED, _SPANS) + """SELECT c.conv_id, c.turn, s.hit_start FROM cues c JOIN spans s ON s.conv_id = c.conv_id
  AND c.start_ms >= s.hit_start_ms AND c.end_ms <= s.hit_end_ms AND c.end_ms > c.start_ms""",
)
def cues_in_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    cues = _looped(spark, sf_dir)
    spans = _hit_spans(cues).select("conv_id", "hit_start", "hit_start_ms", "hit_end_ms")
    return Q.cues_inside(cues.select("conv_id", "turn", "start_ms", "end_ms"), spans, "conv_id", "hit_start_ms", "hit_end_ms").select("conv_id", "turn", "hit_start")


_CLEANED = [
    *_MERGED, _SPANS,
    """cl0 AS (SELECT *, coalesce(cue_from > max(cue_to) OVER (PARTITION BY conv_id ORDER BY hit_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh FROM spans)""",
    "cl1 AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY conv_id ORDER BY hit_start) AS cl FROM cl0)",
    "cl2 AS (SELECT conv_id, cl, min(cue_from) AS head, max(cue_to) AS tail FROM cl1 GROUP BY 1, 2)",
    """sv AS (SELECT p.conv_id, p.p, p.w FROM wp p WHERE NOT EXISTS (SELECT 1 FROM merged h WHERE h.conv_id = p.conv_id AND p.p >= h.hit_start + h.k AND p.p < h.hit_end))""",
    """own AS (SELECT sv.*, c.turn, coalesce(g.head, c.turn) AS home, g.head IS NOT NULL AS was_cleaned FROM sv
  JOIN cues c ON c.conv_id = sv.conv_id AND sv.p >= c.word_start AND sv.p < c.word_end
  LEFT JOIN cl2 g ON g.conv_id = c.conv_id AND c.turn BETWEEN g.head AND g.tail)""",
    "txt AS (SELECT conv_id, home AS turn, bool_or(was_cleaned) AS was_cleaned, string_agg(w, ' ' ORDER BY p) AS content FROM own GROUP BY 1, 2)",
]


@query(
    "cleaned_cues",
    with_(*_CLEANED) + """SELECT t.conv_id, t.turn, c.start_ms, c.end_ms, t.content, t.was_cleaned,
  row_number() OVER (PARTITION BY t.conv_id ORDER BY t.turn) AS new_index FROM txt t JOIN cues c USING (conv_id, turn)""",
)
def cleaned_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    cues = _looped(spark, sf_dir)
    return R.collapse_in_cues(cues, _merged(cues), "conv_id", "turn", "words")


@query(
    "cleaned_check",
    with_(*_CLEANED, "again AS (SELECT conv_id, list(w ORDER BY p) AS words FROM own GROUP BY 1)", *_runs_sql("again", "conv_id", "z"))
    + "SELECT (SELECT count(*) FROM again) AS transcripts, (SELECT count(*) FROM zhit) AS hits_left",
)
def cleaned_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What detection finds when it runs again over the whole cleaned transcripts."""
    cues = _looped(spark, sf_dir)
    cleaned = R.collapse_in_cues(cues, _merged(cues), "conv_id", "turn", "words").select("conv_id", "turn", "content")
    again = materialize(Q.word_offsets(cleaned, "conv_id", "turn", F.col("content")).withColumn("words", T.words("content")), "cleaned-again")
    hits = R.classify(R.transcript_runs(again, "conv_id", "turn", "words"))
    both = again.select("conv_id", F.lit(0).alias("hit")).unionByName(hits.select("conv_id", F.lit(1).alias("hit")))
    return both.agg(F.count_distinct(F.when(F.col("hit") == 0, F.col("conv_id"))).alias("transcripts"), F.sum("hit").cast("long").alias("hits_left"))


@query(
    "collapsed_repeats",
    f"""SELECT conv_id, turn, replace({prepare('content')}, repeat(f || ' ', n - 1) || f, f) AS collapsed FROM
  (SELECT conv_id, turn, {_LOOP} AS content, array_to_string({words(prepare('text'))}[1:turn % 4 + 1], ' ') AS f, turn + 7 AS n FROM conversations)""",
)
def collapsed_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "conversations")
    looped = views.cues(spark, sf_dir, looped=True).select("conv_id", "turn", "content")
    first = F.array_join(F.slice(T.words(T.prepare("text")), F.lit(1), (F.col("turn") % 4 + 1).cast("int")), " ")
    both = looped.join(rows.select("conv_id", "turn", first.alias("phrase")), ["conv_id", "turn"])
    return both.select("conv_id", "turn", T.collapse_repeats("content", "phrase", F.col("turn") + 7).alias("collapsed"))


@query(
    "detection_summary",
    with_(*_HITS) + """SELECT count(*) AS files_processed, (SELECT count(DISTINCT conv_id) FROM cues) - count(*) AS files_failed, count(h) AS files_with_hits, CAST(coalesce(sum(h), 0) AS BIGINT) AS total_hits,
  CAST(sum(n) AS BIGINT) AS total_windows FROM (SELECT conv_id, count(*) AS n FROM win GROUP BY 1)
  LEFT JOIN (SELECT conv_id, count(*) AS h FROM hits GROUP BY 1) USING (conv_id)""",
)
def detection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = materialize(_windows(spark, sf_dir), "windows")
    return R.detection_summary(windows, R.window_hits(windows, "conv_id"), "conv_id", views.table(spark, sf_dir, "conversations"))


@query(
    "hit_digest",
    with_(*_HITS) + """SELECT conv_id, count(*) OVER (PARTITION BY conv_id) AS n_hits, hits.window_id, hit_start,
  hit_start || ': ' || k || ' words x ' || reps || ': ' || array_to_string(win.words[s + 1:s + k], ' ') AS line
  FROM hits JOIN win USING (conv_id, window_id)""",
)
def hit_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits in transcript order with the count of their transcript."""
    return writers.hit_digest(R.window_hits(_windows(spark, sf_dir), "conv_id"), "conv_id")


@query(
    "detection_reports",
    with_(
        *_MERGED, _SPANS, *_WINDOWS[-2:],
        """hj AS (SELECT conv_id, hit_start // 1048576 AS part, count(*) AS n, to_json(list({'hit_start_ms': hit_start_ms, 'hit_end_ms': hit_end_ms, 'hit_start': hit_start,
  'hit_end': hit_end, 'repetition_length': k, 'repetitions': reps} ORDER BY hit_start_ms, hit_end_ms, hit_start)) AS hits FROM spans JOIN merged USING (conv_id, hit_start) GROUP BY 1, 2)""",
        "tw AS (SELECT conv_id, window_start // 1048576 AS part, count(*) AS total_windows FROM win GROUP BY 1, 2)",
    ) + "SELECT conv_id, part, total_windows, coalesce(n, 0) AS total_hits, coalesce(CAST(hits AS VARCHAR), '[]') AS hits FROM tw LEFT JOIN hj USING (conv_id, part)",
)
def detection_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested reports written as JSON and read back."""
    cues = _looped(spark, sf_dir)
    windows = R.word_windows(cues, "conv_id", "turn", "words")
    reports = writers.detection_reports(_hit_spans(cues), "conv_id", windows)
    path = scratch_dir(spark, "reports")
    writers.write_json(reports, path)
    stored = spark.read.schema(reports.schema).json(path)
    return stored.select("conv_id", "part", "total_windows", "total_hits", F.to_json("hits").alias("hits"))


@query(
    "decision_scores",
    """SELECT doc_id, round(0.888846 * r + 0.666538 * k - 6.777051, 6) AS svm, round(1.0713804477 * r + 0.7981359963 * k - 9.1584997404, 6) AS logistic,
  round(-0.0005429170 + 0.0380797988 * r + 0.0280639033 * k + 0.2609198746 * r * r + 0.3383034829 * r * k + 0.1560897638 * k * k - 15.5181124275, 6) AS quadratic,
  round(1.0 / (1.0 + exp(-(1.0713804477 * r + 0.7981359963 * k - 9.1584997404))), 6) AS probability
  FROM (SELECT doc_id, CAST(n_chars % 12 AS DOUBLE) AS r, CAST(doc_id % 7 + 1 AS DOUBLE) AS k FROM documents)""",
)
def decision_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    reps, k = (F.col("n_chars") % 12).cast("double"), (F.col("doc_id") % 7 + 1).cast("double")
    logistic = S.linear_score(reps, k, S.LINEAR_LOGISTIC)
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", F.round(S.linear_score(reps, k), 6).alias("svm"), F.round(logistic, 6).alias("logistic"),
        F.round(S.quadratic_score(reps, k), 6).alias("quadratic"), F.round(S.probability(logistic), 6).alias("probability"),
    )


# --- intervals ----------------------------------------------------------------

_SIL = """sil AS (SELECT user_id AS rec, event_id * 1000 AS start_ms, event_id * 1000 + CAST(floor(value) AS BIGINT) + 1 AS end_ms FROM events
  WHERE event_type = 'view'), tot AS (SELECT DISTINCT user_id AS rec, (SELECT (max(event_id) + 1) * 1000 FROM events) AS total_ms FROM events)"""
_SPEECH = """gp AS (SELECT rec, coalesce(lag(end_ms) OVER (PARTITION BY rec ORDER BY start_ms), 0) AS from_ms, start_ms AS to_ms FROM sil
  UNION ALL SELECT t.rec, coalesce(e, 0), total_ms FROM tot t LEFT JOIN (SELECT rec, arg_max(end_ms, start_ms) AS e FROM sil GROUP BY 1) USING (rec)),
sp AS (SELECT * FROM gp WHERE to_ms - from_ms >= 10),
tr AS (SELECT *, CAST(sum(to_ms - from_ms) OVER (PARTITION BY rec ORDER BY from_ms) AS BIGINT) AS trimmed_to FROM sp)"""


def _silences(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Silences of a recording per user, and its length."""
    events = views.table(spark, sf_dir, "events")
    start = F.col("event_id") * 1000
    sil = events.where("event_type = 'view'").select(
        F.col("user_id").alias("rec"), start.alias("start_ms"), (start + F.floor("value").cast("long") + 1).alias("end_ms")
    )
    total = events.agg(((F.max("event_id") + 1) * 1000).alias("t")).scalar()
    return sil, events.select(F.col("user_id").alias("rec")).distinct().withColumn("total_ms", total)


@query("speech_intervals", with_(_SIL, _SPEECH) + "SELECT rec, from_ms, to_ms FROM sp")
def speech_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.complement(*_silences(spark, sf_dir), "rec")


@query("trimmed_segments", with_(_SIL, _SPEECH) + "SELECT rec, from_ms, to_ms, trimmed_to - (to_ms - from_ms) AS trimmed_from, trimmed_to FROM tr")
def trimmed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.trimmed(V.complement(*_silences(spark, sf_dir), "rec"), "rec").select(
        "rec", "from_ms", "to_ms", "trimmed_from", "trimmed_to"
    )


@query(
    "trimmed_to_original",
    with_(_SIL, _SPEECH) + """SELECT event_id, t, (SELECT from_ms + t - (trimmed_to - (to_ms - from_ms)) FROM tr WHERE tr.rec = e.user_id
    AND t BETWEEN trimmed_to - (to_ms - from_ms) AND trimmed_to ORDER BY from_ms LIMIT 1) AS original_ms
  FROM (SELECT event_id, user_id, event_id * 997 AS t FROM events) e""",
)
def trimmed_to_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = V.trimmed(V.complement(*_silences(spark, sf_dir), "rec"), "rec")
    points = views.table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("rec"), (F.col("event_id") * 997).alias("t")
    )
    return V.to_original(points, kept, "rec", "t").select("event_id", "t", "original_ms")


def _stored_logs(spark: SparkSession, lines: DataFrame, key: str, per_file: int) -> DataFrame:
    """(key, position, line) of logs that were written as text files of at most ``per_file`` lines."""
    root = scratch_dir(spark, "logs")
    writers.write_logs(lines, key, "event_id", root, per_file=per_file)
    read = files.ordered_lines(spark, root, ".txt")
    return materialize(read.select(F.regexp_extract("folder", f"{key}=([^/]*)$", 1).alias(key), "position", "line"), "log-lines")


@query(
    "silence_log",
    """SELECT user_id AS rec, CAST(round(a * 1000) AS BIGINT) AS start_ms, CAST(round(b * 1000) AS BIGINT) AS end_ms FROM
  (SELECT user_id, event_type, CAST(event_id AS DOUBLE) AS b, lag(event_type) OVER w AS prev, CAST(lag(event_id) OVER w AS DOUBLE) AS a
   FROM events WHERE event_type IN ('view', 'click') WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE event_type = 'click' AND prev = 'view'""",
)
def silence_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files per user, read back by line: views open a silence, clicks close it."""
    e = F.col("event_id").cast("string")
    line = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("[silencedetect] silence_start: "), e, F.lit(".0")))
        .when(F.col("event_type") == "click", F.concat(F.lit("[silencedetect] silence_end: "), e, F.lit(".0 | silence_duration: 1.5")))
        .otherwise(F.lit("frame= 1"))
    )
    lines = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("rec"), "event_id", line.alias("line"))
    return V.pair_log_lines(_stored_logs(spark, lines, "rec", 1000).withColumn("rec", F.col("rec").cast("long")), "rec", "position")


_LOG = """lg AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS log_file, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS position,
  CASE WHEN event_type = 'signup' THEN 'https://example.com/@user' || user_id END AS url, CASE WHEN event_type = 'error' THEN 'id' || user_id END AS vid FROM events),
fl AS (SELECT *, last_value(url IGNORE NULLS) OVER (PARTITION BY log_file ORDER BY position) AS channel_url FROM lg),
facts AS (SELECT log_file, channel_url, vid AS video_id, position FROM fl WHERE vid IS NOT NULL AND channel_url IS NOT NULL)"""


def _log_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.running import running

    e = F.col("event_type")
    line = (
        F.when(e == "signup", F.concat(F.lit("[youtube:tab] Extracting URL: https://example.com/@user"), F.col("user_id").cast("string")))
        .when(e == "error", F.concat(F.lit("ERROR: [youtube] id"), F.col("user_id").cast("string"), F.lit(": members only")))
        .otherwise(F.lit("[download] 1%"))
    )
    lines = views.table(spark, sf_dir, "events").select(
        F.to_date("ts").cast("string").alias("log_file"), "event_id", line.alias("line")
    )
    stored = _stored_logs(spark, lines, "log_file", 100)
    filled = running(files.log_facts(stored), ["log_file"], "position", F.col("channel_url"), "channel", how="last")
    return filled.where("video_id is not null and channel is not null").select(
        "log_file", F.col("channel").alias("channel_url"), "video_id", "position"
    )


@query("log_facts", with_(_LOG) + "SELECT * FROM facts")
def log_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error lines of written logs with the channel line before them in the same log."""
    return _log_facts(spark, sf_dir)


@query(
    "log_new_ids",
    with_(_LOG, "arch AS (SELECT DISTINCT 'id' || user_id AS video_id FROM events WHERE event_type = 'purchase' AND value > 40)")
    + """SELECT f.channel_url, count(*) FILTER (a.video_id IS NULL) AS n_new, count(a.video_id) AS n_known FROM facts f LEFT JOIN arch a USING (video_id) GROUP BY 1""",
)
def log_new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids not yet archived and those already known, per channel."""
    archived = views.table(spark, sf_dir, "events").where("event_type = 'purchase' and value > 40").select(
        F.concat(F.lit("id"), F.col("user_id").cast("string")).alias("video_id"), F.lit(True).alias("known")
    ).distinct()
    return _log_facts(spark, sf_dir).join(archived, "video_id", "left").groupBy("channel_url").agg(
        F.count_if(F.col("known").isNull()).alias("n_new"), F.count("known").alias("n_known")
    )
