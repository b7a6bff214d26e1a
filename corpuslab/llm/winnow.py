"""Benchmark decontamination by winnowed fingerprints, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import hold
from ..session import Scratch
from .common import id_and_text
from .licenses import words

#: Words that have to be shared.
WINDOW = 10
#: Words of a fingerprinted k-gram; windows of ``WINDOW - GRAM + 1`` k-grams keep their smallest.
GRAM = 8


def _shifted(a: Column, by: int) -> Column:
    return F.slice(a, F.lit(by + 1), F.greatest(F.size(a) - by, F.lit(0)))


def _first(a: Column, n: Column) -> Column:
    return F.slice(a, F.lit(1), F.greatest(n, F.lit(0)))


def with_grams(df: DataFrame, ws: str, n: int, out: str) -> DataFrame:
    """Add ``out``: hash of the ``n`` words from each position on.

    Hashes of long runs are made of those of two shorter ones, so the passes over a
    text are the logarithm of ``n``.
    """
    df = hold(df, **{out: F.transform(ws, lambda w: F.xxhash64(w))})
    have = 1
    while have < n:
        step = min(have, n - have)
        # two runs of ``have`` words, ``step`` apart, cover ``have + step`` words
        both = F.zip_with(out, _shifted(F.col(out), step), lambda a, b: F.xxhash64(a, b))
        have += step
        df = hold(df, **{out: both})
    return hold(df, **{out: _first(F.col(out), F.size(ws) - n + 1)})


def with_minima(df: DataFrame, grams: str, width: int, out: str) -> DataFrame:
    """Add ``out``: distinct smallest k-gram hashes of all windows of ``width`` neighbouring k-grams."""
    kept = F.col(grams)
    have = 1
    while have < width:
        step = min(have, width - have)
        kept = F.zip_with(kept, _shifted(kept, step), lambda a, b: F.least(a, b))
        have += step
        df = hold(df, __min=kept)
        kept = F.col("__min")
    return hold(df, **{out: F.array_distinct(_first(kept, F.size(grams) - width + 1))}).drop("__min")


def fingerprints(df: DataFrame, ws: str, window: int, gram: int, out: str) -> DataFrame:
    """Add ``out``: the winnowed fingerprints of a text.

    Two texts that share ``window`` consecutive words share the smallest of the k-grams
    in there, so they have at least one fingerprint in common.
    """
    df = with_grams(df, ws, gram, "__grams")
    return with_minima(df, "__grams", window - gram + 1, out).drop("__grams")


def benchmark_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, n, ws): each run of ``window`` words of an item; an item of fewer words, but not none, is one."""
    d = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = hold(d, ws=words(F.col("text"))).drop("text").where(F.size("ws") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - window + 1, F.lit(1)))
    d = d.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("ws", i, window))).alias("ws"))
    return d.select("item_id", F.size("ws").alias("n"), "ws")


def covered(spans: Column) -> Column:
    """Positions inside any of the spans (start, n), sorted by start."""
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def step(acc, s):
        stop = (s["start"] + s["n"]).cast("long")
        return F.struct((acc["n"] + F.greatest(stop - F.greatest(s["start"].cast("long"), acc["end"]), F.lit(0))).alias("n"), F.greatest(stop, acc["end"]).alias("end"))

    return F.aggregate(spans, begin, step)["n"]


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per input row.

    A document word is hit when it lies in an occurrence of a window of ``window``
    consecutive item words (an item of fewer words is one window).  Fingerprints of
    documents and items are joined; documents with a hit are extended: all their runs of
    ``window`` words are looked up by hash, and what is found is compared word by word.

    Null texts have no words; null items count under the text "null"; repeated rows each
    give a row, null ids pass through; without items nothing is hit; an empty table gives
    no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontamination")
    d = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    wins = scratch.save(benchmark_windows(items, window, item_col, item_text_col).withColumn("phrase", F.array_join("ws", " ")), "windows")
    lengths = sorted(r["n"] for r in wins.select("n").distinct().collect())  # at most ``window`` values

    found = []
    for n in lengths:
        k = min(gram, n)
        of_items = fingerprints(wins.where(F.col("n") == n).select("ws"), "ws", n, k, "fps").select(F.explode("fps").alias("fp")).distinct()
        of_items = scratch.save(of_items, "fingerprints")  # stored: its size is known, and it is broadcast only if small
        of_docs = fingerprints(hold(d, ws=words(F.col("text"))).drop("text"), "ws", n, k, "fps").select("doc_id", "key", F.explode("fps").alias("fp"))
        found.append(of_docs.join(of_items, "fp").select("doc_id", "key").distinct())
    result = d.select("doc_id", "key", F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n_words"))
    if found:
        hits = found[0]
        for f in found[1:]:
            hits = hits.unionByName(f)
        hits = scratch.save(hits.distinct(), "candidates")
        spans = _extend(d, hits, wins, lengths, window, scratch)
        on = result["doc_id"].eqNullSafe(spans["_id"]) & (result["key"] == spans["_key"])
        result = result.join(spans, on, "left")
    else:
        result = result.withColumn("n_hit", F.lit(None).cast("long")).withColumn("items", F.array().cast("array<string>"))
    items_list = F.coalesce("items", F.array().cast("array<string>"))
    return result.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items_list).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_list, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _extend(d: DataFrame, hits: DataFrame, wins: DataFrame, lengths: list[int], window: int, scratch: Scratch) -> DataFrame:
    """(_id, _key, n_hit, items) of the documents with a window, by exact comparison."""
    hits = hits.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    same = d["doc_id"].eqNullSafe(hits["_id"]) & (d["key"] == hits["_key"])
    # one row per id and text from here on; their copies share the result
    cand = scratch.save(hold(d.join(hits, same, "left_semi").dropDuplicates(["doc_id", "key"]), ws=words(F.col("text"))).drop("text"), "texts")
    phrases = wins.select("n", "ws", "phrase").dropDuplicates(["n", "phrase"])
    at = []
    for n in lengths:
        hashed = scratch.save(with_grams(phrases.where(F.col("n") == n), "ws", n, "h").select(F.col("h")[0].alias("h"), "n", "phrase"), "phrases")
        runs = with_grams(cand, "ws", n, "h").select("doc_id", "key", F.posexplode("h").alias("start", "h"))
        at.append(runs.join(hashed, "h").select("doc_id", "key", F.struct("start", "n", "phrase").alias("span")))
    spans = at[0]
    for a in at[1:]:
        spans = spans.unionByName(a)
    spans = spans.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("span")).alias("spans")).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "spans")
    exact = cand.join(spans, cand["doc_id"].eqNullSafe(spans["_id"]) & (cand["key"] == spans["_key"]))
    exact = hold(exact, spans=F.filter("spans", lambda s: F.array_join(F.slice("ws", s["start"] + 1, s["n"]), " ") == s["phrase"]))
    exact = scratch.save(
        exact.select("_id", "_key", covered(F.col("spans")).alias("n_hit"), F.array_distinct(F.transform("spans", lambda s: s["phrase"])).alias("phrases")).where("n_hit > 0"), "spans"
    )
    ids = wins.select("phrase", F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item")).distinct()
    of_item = exact.select("_id", "_key", F.explode("phrases").alias("phrase")).join(ids, "phrase").groupBy("_id", "_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    other = of_item.select(F.col("_id").alias("_id2"), F.col("_key").alias("_key2"), "items")
    return exact.join(other, exact["_id"].eqNullSafe(other["_id2"]) & (exact["_key"] == other["_key2"])).select("_id", "_key", "n_hit", "items")


def sql() -> str:
    """The same rows by joining every run of words."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cut = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH d AS (SELECT doc_id, {cut} AS ws FROM documents), b AS (SELECT item_id, {cut} AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS n, array_to_string(ws[i + 1 : i + {WINDOW}], ' ') AS phrase
  FROM b, unnest(range(greatest(len(ws) - {WINDOW} + 1, 1))) AS t(i) WHERE len(ws) > 0
), lens AS (SELECT DISTINCT n FROM wins),
runs AS (
  SELECT doc_id, i, n, array_to_string(ws[i + 1 : i + n], ' ') AS phrase FROM d, lens, unnest(range(greatest(len(ws) - n + 1, 0))) AS t(i)
), hits AS (SELECT doc_id, i, wins.n, item_id FROM runs JOIN wins ON runs.n = wins.n AND runs.phrase = wins.phrase),
places AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(n)) AS t(k) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN its USING (doc_id)
"""
