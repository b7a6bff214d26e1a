"""Theme, timeline and digest jobs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import bucket_key
from ..functions.text import normalize_markdown, strip_ws
from ..operators import corpus, tfidf
from ..operators.topn import ranked, top_per_group
from ..session import materialize
from . import markdown

TOP_TERMS = 50
TOP_PHRASES = 30
MIN_DOCUMENTS = 2
TOP_VIDEOS = 10
NGRAMS = (1, 2)
BUCKET_TOP = 5
LOOKBACK_DAYS = 30


def document_text(rows: DataFrame, summary: str, transcript: str | None = None) -> DataFrame:
    """Add ``document``: the normalized summary, with the normalized transcript
    appended where asked for."""
    text = normalize_markdown(F.col(summary))
    if transcript is not None:
        text = strip_ws(F.concat_ws(" ", text, normalize_markdown(F.col(transcript))))
    return rows.withColumn("document", text)


def theme_weights(docs: DataFrame, doc: str, ngrams: tuple[int, int] = NGRAMS, **knobs) -> DataFrame:
    """Weights over rows with ``document``, ``channel`` and a unique ``doc``."""
    extra = [c for c in ("title", "upload_date", "summary_md") if c in docs.columns and c != doc]
    return tfidf.weights(docs.select(doc, "channel", *extra, "document"), doc, "document", ngrams=ngrams, **knobs)


def term_report(found: DataFrame, n: int = TOP_TERMS) -> DataFrame:
    return ranked(found.where(~tfidf.is_phrase()), [F.desc("score"), F.asc("term")], n, "rank")


def phrase_report(found: DataFrame, n: int = TOP_PHRASES, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    kept = found.where(tfidf.is_phrase() & (F.col("document_frequency") >= min_documents))
    return ranked(kept, [F.desc("document_frequency"), F.desc("score"), F.asc("term")], n, "rank")


def timeline(docs: DataFrame, doc: str, bucket: str, ngrams: tuple[int, int] = NGRAMS, min_documents: int = MIN_DOCUMENTS, **knobs) -> DataFrame:
    """Per bucket: videos, channel map, top terms and phrases with TF-IDF local
    to the bucket.  One job for all buckets."""
    placed = docs.withColumn("bucket", bucket_key(F.col("upload_date"), bucket))
    weighted = tfidf.weights(placed.select(doc, "channel", "bucket", "document"), doc, "document", ["bucket"], ngrams, **knobs)
    found = tfidf.entries(weighted, ["bucket"]).drop("channels")
    terms = top_per_group(
        found.where(~tfidf.is_phrase()), ["bucket"], [F.desc("score"), F.asc("term")], BUCKET_TOP, "term", "r"
    )
    kept = found.where(tfidf.is_phrase() & (F.col("document_frequency") >= min_documents))
    phrases = top_per_group(
        kept, ["bucket"], [F.desc("document_frequency"), F.desc("score"), F.asc("term")], BUCKET_TOP, "term", "r"
    )

    def listing(rows: DataFrame, name: str) -> DataFrame:
        items = F.transform(F.array_sort(F.collect_list(F.struct("r", "term"))), lambda s: s["term"])
        return rows.groupBy("bucket").agg(items.alias(name))

    none = F.array().cast("array<string>")
    return (
        corpus.bucket_counts(placed)
        .join(listing(terms, "top_terms"), "bucket", "left")
        .join(listing(phrases, "top_phrases"), "bucket", "left")
        .withColumns({"top_terms": F.coalesce("top_terms", none), "top_phrases": F.coalesce("top_phrases", none)})
    )


def emerging(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Terms of this run that the previous one lacks; empty on a first run."""
    if previous is None:
        return current.select("term").limit(0)
    return current.select("term").join(previous.select("term"), "term", "left_anti").distinct()


@dataclass(frozen=True)
class Previous:
    """Day, terms and phrases (``term``) of the run before."""

    day: str
    terms: DataFrame
    phrases: DataFrame


def build_digest(
    index: DataFrame,
    docs: DataFrame,
    doc: str,
    reference: dt.date,
    previous: Previous | None,
    bucket: str = "week",
    lookback_days: int = LOOKBACK_DAYS,
    channel: str | None = None,
) -> dict[str, DataFrame]:
    """Index, themes, timeline, emerging terms and phrases, and the Markdown lines of the
    three reports of one run.

    ``docs`` are the candidate rows with ``document``, ``title``, ``upload_date`` and
    ``summary_md``.  ``previous`` is checked before anything is written; None is a first
    run.  The weights and the capped reports feed several parts, so they are written once
    to the scratch folder.
    """
    for name, rows in (("terms", previous.terms), ("phrases", previous.phrases)) if previous else ():
        if "term" not in rows.columns:
            raise ValueError(f"previous snapshot has no 'term' column in its {name}")
    weighted = materialize(theme_weights(docs, doc), "theme-weights")
    found = tfidf.entries(weighted)
    terms = materialize(term_report(found), "terms")
    phrases = materialize(phrase_report(found), "phrases")
    videos = materialize(tfidf.top_documents(weighted, phrases, doc, "title", TOP_VIDEOS), "videos")
    buckets = materialize(timeline(docs, doc, bucket), "buckets")
    new_terms = emerging(terms, previous.terms if previous else None)
    new_phrases = emerging(phrases, previous.phrases if previous else None)
    window = {"lookback_days": lookback_days, "channel": channel}
    day = previous.day if previous else None
    return {
        "terms": terms,
        "phrases": phrases,
        "videos": videos,
        "timeline": buckets,
        "emerging": new_terms,
        "emerging_phrases": new_phrases,
        "themes_report": markdown.theme_lines(docs, terms, phrases, **window),
        "timeline_report": markdown.timeline_lines(docs, buckets, bucket, **window),
        "digest": markdown.digest_lines(index, docs, terms, phrases, videos, buckets, new_terms, new_phrases, reference, day, bucket, **window),
    }
