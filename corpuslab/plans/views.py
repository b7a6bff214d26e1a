"""Views over the given tables that play the part of the library's inputs.

``documents`` stand for transcripts and summaries, ``events`` for publication
metadata, ``conversations`` for timed cues, ``pages`` for raw pages.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import prepare, words
from ..operators.cues import word_offsets

REFERENCE = dt.date(2024, 3, 1)
FIRST_DAY = dt.date(2023, 12, 1)
MS_PER_WORD = 400


# Tables whose rows cost much CPU, and the key that spreads them.
_HEAVY = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as it lies; where the session sets
    ``spark.corpuslab.inputPartitions``, text tables are dealt over so many parts."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get("spark.corpuslab.inputPartitions", "")
    return df.repartition(int(parts), _HEAVY[name]) if parts and name in _HEAVY else df


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, channel, title, upload_date, has_summary, text, lang."""
    docs = table(spark, sf_dir, "documents")
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("__l", F.lit(True))
    return docs.join(labelled, "doc_id", "left").select(
        "doc_id",
        F.col("source").alias("channel"),
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
        F.date_add(F.lit(FIRST_DAY), (F.col("doc_id") % 90).cast("int")).alias("upload_date"),
        F.coalesce("__l", F.lit(False)).alias("has_summary"),
        "text",
        "lang",
    )


def channel_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("channel"),
        F.when(F.col("n_nationkey") % 4 == 0, "de").otherwise("en").alias("language"),
        F.lower("r_name").alias("category"),
        F.col("n_name").alias("description"),
    )


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """channel, channel_id, published_at, duration_s, title, video_id."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("channel"),
        F.concat(F.lit("UC"), F.col("user_id").cast("string")).alias("channel_id"),
        F.col("ts").alias("published_at"),
        F.col("value").alias("duration_s"),
        F.col("event_type").alias("title"),
        F.concat(F.lit("ev"), F.col("event_id").cast("string")).alias("video_id"),
        "event_id",
        "user_id",
    )


def cues(spark: SparkSession, sf_dir: str, looped: bool = False) -> DataFrame:
    """conv_id, turn, content, words, word span and times (400 ms a word).

    With ``looped`` every fifth turn ends in a repeated phrase, as a speech
    model that ran away would leave it; the phrase is the turn's first words.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("content"))
    if looped:
        first = F.slice(words(prepare("content")), F.lit(1), (F.col("turn") % 4 + 1).cast("int"))
        tail = F.repeat(F.concat(F.lit(" "), F.array_join(first, " ")), (F.col("turn") + 7).cast("int"))
        loop = (F.col("conv_id") + F.col("turn")) % 5 == 0
        rows = rows.withColumn("content", F.when(loop, F.concat("content", tail)).otherwise(F.col("content")))
    placed = word_offsets(rows, "conv_id", "turn", prepare("content"))
    return placed.withColumns(
        {
            "words": words(prepare("content")),
            "start_ms": F.col("word_start") * MS_PER_WORD,
            "end_ms": F.col("word_end") * MS_PER_WORD,
        }
    )


def inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """position, line: each page URL as an inbox line, twice for every fourth
    page, with a category prefix for every third; some lines cannot be used."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    i = F.col("page_id")
    line = (
        F.when(i % 17 == 5, F.concat(F.lit("ftp://host"), i.cast("string"), F.lit(".org/x")))
        .when(i % 17 == 6, F.lit("not a url"))
        .when(i % 17 == 7, F.lit("plainword"))
        .when(i % 17 == 8, F.concat(F.lit("https://arxiv.org/abs/2301."), i.cast("string")))
        .when(i % 17 == 9, F.concat(F.lit("www.Example.org:8080/Paper"), i.cast("string"), F.lit(".PDF#p2")))
        .when(i % 17 == 10, F.concat(F.lit("http://user@HOST.net:99999/"), i.cast("string")))
        .when(i % 17 == 11, F.concat(F.lit("https://www.youtube.com/watch?v="), i.cast("string")))
        .when(i % 17 == 12, F.concat(F.lit("https://docs.site.org/a."), i.cast("string"), F.lit(".md")))
        .when(i % 17 == 13, F.concat(F.lit("https://docs.site.org/a_"), (i - 1).cast("string"), F.lit("_md")))
        .when(i % 17 == 14, F.concat(F.lit("https://long.site.org/"), F.repeat(F.lit("part-"), 60), i.cast("string")))
        .when(i % 3 == 0, F.concat(F.lit("cat->sub:"), F.col("url")))
        .otherwise(F.col("url"))
    )
    copies = F.when(i % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = pages.select("page_id", line.alias("line"), F.explode(copies).alias("c"))
    return rows.select((F.col("page_id") * 2 + F.col("c")).alias("position"), "line")


# Fixed values of the file view: stage, suffix, divisor, remainder (a document
# has the file unless doc_id % divisor = remainder).
STAGE_FILES = [
    ("videos", "mp4", 3, 0), ("archive", "mp4", 4, 1), ("audio", "wav", 3, 1), ("transcripts", "srt", 7, 3),
    ("transcripts", "txt", 7, 3), ("hallucinations", "json", 5, 2), ("cleaned", "srt", 5, 2), ("cleaned", "txt", 5, 2),
    ("summaries", "md", 5, 4), ("metadata", "info.json", 11, 6),
]


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stage, channel, dir, name, size, mtime, path: files per document.

    Every ninth document also has a copy without an id, every 23rd only that;
    every 13th an interrupted merge; every 19th an empty transcript.
    """
    d, n = F.col("doc_id"), F.col("n_chars")
    ident = F.lpad(F.concat(F.lit("id"), d.cast("string")), 11, "x")
    title = F.concat(F.lit("Doc "), d.cast("string"))
    rows = []
    for stage, ext, div, rem in STAGE_FILES:
        size = n * (1000 if ext == "mp4" else 1)
        if stage == "transcripts":
            size = F.when(d % 19 == 4, F.lit(0)).when(d % 29 == 4, F.lit(60)).otherwise(n)
        size = size.cast("long") if not isinstance(size, int) else F.lit(size)
        present = d % div != rem
        named = F.concat(title, F.lit(" ["), ident, F.lit("]." + ext))
        plain = F.concat(title, F.lit("." + ext))

        def entry(cond, name, size=size, stage=stage):
            return F.when(cond, F.struct(F.lit(stage).alias("stage"), name.alias("name"), size.alias("size")))

        rows.append(entry(present & (d % 23 != 22), named))
        rows.append(entry(present & ((d % 9 == 1) | (d % 23 == 22)), plain))
    part = F.concat(title, F.lit(" ["), ident, F.lit("].f251-11.webm"))
    side = F.concat(F.lit("._"), title, F.lit(" ["), ident, F.lit("].mp4"))
    for cond, name, size in ((d % 13 == 0, part, n), (d % 31 == 0, side, F.lit(4))):
        rows.append(F.when(cond, F.struct(F.lit("videos").alias("stage"), name.alias("name"), size.cast("long").alias("size"))))
    docs = table(spark, sf_dir, "documents")
    files = docs.select("doc_id", F.col("source").alias("channel"), F.explode(F.array_compact(F.array(*rows))).alias("f"))
    return files.select(
        F.col("f.stage").alias("stage"), "channel", F.lit("").alias("dir"), F.col("f.name").alias("name"),
        F.col("f.size").alias("size"), (F.lit(1700000000) + d * 60).alias("mtime"),
        F.concat_ws("/", "f.stage", "channel", "f.name").alias("path"), "doc_id",
    )


def filter_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stage, entry (``channel/id``): the toxic documents, listed at a stage
    each; a few entries lack the channel."""
    d = F.col("doc_id")
    stage = F.when(d % 3 == 0, "videos").when(d % 3 == 1, "audio").otherwise("transcripts")
    ident = F.lpad(F.concat(F.lit("id"), d.cast("string")), 11, "x")
    entry = F.when(d % 7 == 3, ident).otherwise(F.concat("source", F.lit("/"), ident))
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    docs = table(spark, sf_dir, "documents").join(toxic, "doc_id", "left_semi")
    return docs.select(stage.alias("stage"), entry.alias("entry"))


MODELS = ["m0", "m1", "m2", "m3", "m4", "m5"]


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, item, expected, predicted, match: six graders over every label;
    they err on different documents, and one skips the toxic ones."""
    labels = table(spark, sf_dir, "labels")
    d, m = F.col("doc_id"), F.col("m")
    rows = labels.withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(len(MODELS) - 1))))
    expected = F.when(F.col("quality") == 1, "PASS").otherwise("FAIL")
    flipped = F.when(F.col("quality") == 1, "FAIL").otherwise("PASS")
    predicted = F.when((d * (m + 3)) % 41 == 7, "ERROR").when((d * (m + 5)) % 13 < m, flipped).otherwise(expected)
    kind = F.when(F.col("quality") == 1, "good_").otherwise("bad_")
    out = rows.where(~((m == 4) & (F.col("toxic") == 1))).select(
        F.concat(F.lit("m"), m.cast("string")).alias("model"),
        F.concat(kind, d.cast("string"), F.lit(".sh")).alias("item"),
        expected.alias("expected"),
        predicted.alias("predicted"),
        d.alias("doc_id"),
    )
    return out.withColumn("match", F.when(F.col("expected") == F.col("predicted"), "Y").otherwise("N"))
