"""URL inbox: canonical rows, dedupe, collisions, waterfalls, pending work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import hold
from ..functions.text import collapse_ws, strip_ws
from ..functions.urls import (
    CONTENT_TYPES, RAW_SUFFIX, assemble, content_type, embedded_url, file_stem, full_url, host_of, port_of, refusal, url_parts,
)
from .matching import left_join_known

RECOVERABLE_TYPES = list(RAW_SUFFIX)


def canonical_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``normalized_url`` and ``reason`` to inbox lines; one is set.

    User info and fragment are dropped, scheme and host go to lower case, the
    query is kept.  Each step is computed once per row.
    """
    full = hold(lines, __full=full_url(embedded_url(F.col(line))))
    parts = hold(full, __parts=url_parts(F.col("__full")))
    p = F.col("__parts")
    slashes = F.get(p, F.lit(1)) == "//"
    server = F.regexp_replace(F.when(slashes, F.get(p, F.lit(2))).otherwise(F.lit("")), "^.*@", "")
    path = F.when(slashes, F.get(p, F.lit(3))).otherwise(F.concat(F.get(p, F.lit(2)), F.get(p, F.lit(3))))
    named = hold(
        parts,
        __scheme=F.lower(F.get(p, F.lit(0))),
        __host=host_of(server),
        __port=port_of(server),
        __path=path,
        __query=F.get(p, F.lit(4)),
    )
    c = {k: F.col(f"__{k}") for k in ("scheme", "host", "port", "path", "query")}
    url = strip_ws(embedded_url(F.col(line)))
    judged = hold(named, reason=refusal(url, c["scheme"], c["host"], c["port"]))
    out = judged.withColumn("normalized_url", F.when(F.col("reason").isNull(), assemble(**c)))
    return hold(out.drop("__full", "__parts", *[f"__{k}" for k in c]), normalized_url=F.col("normalized_url"))


def unique_urls(canonical_rows: DataFrame, line: str = "line", order: str = "position") -> DataFrame:
    """One row per URL with its first source line, stem and type."""
    good = canonical_rows.where("normalized_url is not null")
    first = good.groupBy("normalized_url").agg(
        F.min_by(line, order).alias("source_line"), F.count(F.lit(1)).alias("n_lines")
    )
    url = F.col("normalized_url")
    return hold(first, stem=file_stem(url), content_type=content_type(url))


def stem_collisions(urls: DataFrame) -> DataFrame:
    """Stems that several URLs share: ``stem, n_urls``."""
    return urls.groupBy("stem").agg(F.count(F.lit(1)).alias("n_urls")).where("n_urls > 1")


def queued(urls: DataFrame) -> DataFrame:
    return urls.join(stem_collisions(urls).select("stem"), "stem", "left_anti")


def collision_failures(urls: DataFrame) -> DataFrame:
    return urls.join(stem_collisions(urls).select("stem"), "stem", "left_semi").select(
        "source_line", F.concat(F.lit("sanitized URL stem collision: "), F.col("stem")).alias("reason")
    )


def queue_stats(canonical_rows: DataFrame) -> DataFrame:
    """Lines read, unique URLs, duplicate entries, unprocessable lines."""
    return canonical_rows.agg(
        F.count(F.lit(1)).alias("lines_read"),
        F.count_distinct("normalized_url").alias("unique_urls"),
        (F.count("normalized_url") - F.count_distinct("normalized_url")).alias("duplicate_entries"),
        F.count("reason").alias("unprocessable"),
    )


def type_counts(urls: DataFrame) -> DataFrame:
    """Queued URLs per type, zero types included."""
    types = urls.sparkSession.createDataFrame([(t,) for t in CONTENT_TYPES], "content_type string")
    found = urls.groupBy("content_type").agg(F.count(F.lit(1)).alias("n"))
    return types.join(found, "content_type", "left").select("content_type", F.coalesce("n", F.lit(0)).alias("n"))


def not_downloaded(urls: DataFrame, outputs: DataFrame) -> DataFrame:
    """URLs without a non-empty raw output of their type."""
    held = outputs.where("size > 0").select("stem", "content_type").distinct()
    return urls.join(held, ["stem", "content_type"], "left_anti")


def requeue_outcomes(archive: DataFrame, outputs: DataFrame, status: DataFrame, order: str = "position") -> DataFrame:
    """Outcome of every archived line, the first that applies: unprocessable,
    unsupported, already downloaded, duplicate, unreachable, recoverable.

    A line counts as duplicate once an earlier line of the same URL became a
    candidate.  ``status`` holds (normalized_url, http_status, error).
    """
    source = strip_ws(F.regexp_extract("line", r"^([^\t]*)", 1))
    rows = canonical_lines(archive.where(collapse_ws("line") != "").withColumn("source_line", source), "source_line")
    url = F.col("normalized_url")
    rows = hold(rows, stem=file_stem(url), content_type=content_type(url))
    held = outputs.where("size > 0").select("stem", "content_type").distinct().withColumn("__held", F.lit(True))
    gone = status.where(
        F.col("http_status").isin("404", "410") | F.contains(F.lower(F.coalesce("error", F.lit(""))), F.lit("could not resolve host"))
    ).select("normalized_url").distinct().withColumn("__gone", F.lit(True))
    # unprocessable lines have no URL and skip the joins
    usable = rows.where(url.isNotNull())
    joined = usable.join(held, ["stem", "content_type"], "left").join(gone, "normalized_url", "left")
    joined = joined.unionByName(rows.where(url.isNull()), allowMissingColumns=True)
    early = (
        F.when(url.isNull(), "unprocessable")
        .when(~F.col("content_type").isin(RECOVERABLE_TYPES), "unsupported")
        .when(F.col("__held"), "already_downloaded")
        .when(F.col("__gone"), "unreachable")
    )
    marked = joined.withColumn("__early", early)
    first = marked.where("__early is null").groupBy("normalized_url").agg(F.min(order).alias("__first"))
    return left_join_known(marked, first, "normalized_url").withColumn(
        "outcome",
        F.coalesce("__early", F.when(F.col(order) == F.col("__first"), "recoverable").otherwise("duplicate")),
    ).drop("__early", "__first", "__held", "__gone")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def requeue_candidates(outcomes: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Recoverable lines in URL order, after offset and limit."""
    out = outcomes.where("outcome = 'recoverable'").select("normalized_url", "source_line", "content_type").orderBy("normalized_url")
    out = out.offset(offset) if offset else out
    return out if limit is None else out.limit(limit)


def unseen(links: DataFrame, seen: DataFrame, key: str = "link", force: bool = False) -> DataFrame:
    """Links not emitted before; all of them when forced."""
    return links if force else links.join(seen.select(key).distinct(), key, "left_anti")


def seen_after(seen: DataFrame, emitted: DataFrame, key: str = "link") -> DataFrame:
    return seen.select(key).unionByName(emitted.select(key)).distinct()


def archive_lines(done: DataFrame, failed: DataFrame) -> DataFrame:
    """Daily archive rows: ``day, kind, line``; failures carry their reason
    after a tab, every outcome on one line."""
    ok = done.select("day", F.lit("done").alias("kind"), F.col("source_line").alias("line"))
    bad = failed.select(
        "day",
        F.lit("unprocessed").alias("kind"),
        F.concat(collapse_ws("source_line"), F.lit("\t"), collapse_ws("reason")).alias("line"),
    )
    return ok.unionByName(bad)


def consumable(snapshot: DataFrame, current: DataFrame) -> DataFrame:
    """Inbox files whose content hash is the one of the snapshot."""
    return snapshot.select("path", "sha256").join(current.select("path", "sha256"), ["path", "sha256"], "left_semi")
