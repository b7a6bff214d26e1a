"""SQL fragments shared by the reference statements (DuckDB dialect)."""

from __future__ import annotations

from ..functions import text as T
from ..operators.tfidf import STOP_WORDS, TOKEN
from .base import quoted


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rep(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(T.WORD)})"


def n_words(x: str) -> str:
    return f"len({words(x)})"


def strip(x: str) -> str:
    return rep(x, f"^{T.WS}+|{T.WS}+$")


def collapse(x: str) -> str:
    return f"trim({rep(x, T.WS + '+', ' ')})"


def markdown(x: str) -> str:
    for mark in (T.QUOTE_MARK, T.HEADING_MARK, T.LIST_MARK):
        x = rep(x, "(?m)" + mark)
    return collapse(rep(x, T.EMPHASIS_MARK))


def prepare(x: str) -> str:
    return collapse(rep(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}\p{Cf}\p{Co}]"))


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


PUBS = """pubs AS (SELECT 'user' || user_id AS channel, 'UC' || user_id AS channel_id, ts AS published_at,
  value AS duration_s, event_type AS title, 'ev' || event_id AS video_id, event_id, user_id FROM events)"""

CORPUS = """corpus AS (SELECT d.doc_id, d.source AS channel, 'Doc ' || d.doc_id AS title,
  DATE '2023-12-01' + CAST(d.doc_id % 90 AS INTEGER) AS upload_date, l.doc_id IS NOT NULL AS has_summary, d.text, d.lang
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id))"""

CHANNELS = """channel_dim AS (SELECT 'src' || n_nationkey AS channel,
  CASE WHEN n_nationkey % 4 = 0 THEN 'de' ELSE 'en' END AS language, lower(r_name) AS category, n_name AS description
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

CANDIDATES = """cand AS (SELECT * FROM corpus WHERE has_summary AND upload_date >= DATE '2024-03-01' - 30)"""


def week_key(d: str) -> str:
    return f"isoyear({d}) || '-W' || lpad(CAST(weekofyear({d}) AS VARCHAR), 2, '0')"


def month_key(d: str) -> str:
    return f"strftime({d}, '%Y-%m')"


def tfidf(docs: str, group: str | None = None, cap: int = 10000, prefix: str = "") -> list[str]:
    """CTEs toks, feats, tf, vocab, w, found over ``docs`` (doc_id, channel,
    document and the group column)."""
    g = f"{group}, " if group else ""
    on_g = f" AND v.{group} = f.{group}" if group else ""
    stop = quoted(STOP_WORDS)
    p = prefix
    cut = (
        f"QUALIFY row_number() OVER (PARTITION BY {group} ORDER BY sum(tf) DESC, term) <= {cap}"
        if group
        else f"ORDER BY sum(tf) DESC, term LIMIT {cap}"
    )
    sizes = f"SELECT {g}count(*) AS n_docs FROM {docs} GROUP BY ALL" if group else f"SELECT count(*) AS n_docs FROM {docs}"
    join_n = f"JOIN {p}n n ON n.{group} = f.{group}" if group else f"CROSS JOIN {p}n n"
    fg = f"f.{group}, " if group else ""
    return [
        f"""{p}toks AS (SELECT doc_id, {g}channel, list_filter(regexp_extract_all(lower(document), {lit(TOKEN)}),
  lambda x: x NOT IN ({stop})) AS t FROM {docs})""",
        f"""{p}feats AS (SELECT doc_id, {g}channel, unnest(t) AS term FROM {p}toks
  UNION ALL SELECT doc_id, {g}channel, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM {p}toks)""",
        f"{p}tf AS (SELECT doc_id, {g}channel, term, count(*) AS tf FROM {p}feats GROUP BY ALL)",
        f"""{p}vocab AS (SELECT {g}term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM {p}tf GROUP BY {g}term {cut})""",
        f"{p}n AS ({sizes})",
        f"""{p}raw AS (SELECT f.doc_id, {fg}f.channel, f.term, f.tf, v.df, n.n_docs,
  f.tf * (ln((1.0 + n.n_docs) / (1.0 + v.df)) + 1.0) AS raw
  FROM {p}tf f JOIN {p}vocab v ON v.term = f.term{on_g} {join_n})""",
        f"{p}w AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM {p}raw)",
        f"""{p}found AS (SELECT {g}term, round(sum(weight) / max(n_docs), 6) AS score, count(*) AS document_frequency,
  list_sort(list(DISTINCT channel)) AS channels FROM {p}w GROUP BY {g}term)""",
    ]
