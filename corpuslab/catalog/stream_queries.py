"""Streaming forms and trained models; rows-only where SQL has no word for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tfidf
from ..plans import reports, training, views
from ..session import materialize, scratch_dir
from ..sources import writers
from ..sources.runs import Runs
from ..streaming import registry, seen
from .base import query
from .corpus_queries import THEMES, _docs
from .cue_queries import LOOPED, _runs_sql
from .sqltext import CORPUS, with_


def _link_folder(spark: SparkSession, sf_dir: str, part: str) -> str:
    """Links of half of the pages, each twice, as a stream source folder."""
    folder = scratch_dir(spark, "links")
    pages = views.table(spark, sf_dir, "pages")
    first = F.contains("url", F.lit("/en/"))
    rows = pages.where(first) if part == "first" else pages
    rows.select(F.explode(F.array("url", "url")).alias("link")).write.parquet(folder)
    return folder


@query("stream_unseen_links", "SELECT DISTINCT url AS link, CASE WHEN contains(url, '/en/') THEN 'first' ELSE 'second' END AS run FROM pages")
def stream_unseen_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one growing folder, with one seen table, output and checkpoint; what
    each run wrote is read from the output alone."""
    base = scratch_dir(spark, "unseen")
    for run in ("first", "second"):
        arrived = spark.read.schema("link string").parquet(_link_folder(spark, sf_dir, run))
        arrived.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{base}/in")
        links = seen.link_stream(spark, f"{base}/in", "link string, run string")
        seen.emit_unseen(links, f"{base}/seen", f"{base}/out", f"{base}/cp").awaitTermination()
    return spark.read.schema("link string, run string").parquet(f"{base}/out").select("link", "run")


@query("stream_drop_seen", "SELECT DISTINCT url AS link FROM pages")
def stream_drop_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpointed seen-set of the engine."""
    base = scratch_dir(spark, "dedupe")
    links = seen.link_stream(spark, _link_folder(spark, sf_dir, "second"), "link string")
    (
        seen.drop_seen(links).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    )
    return spark.read.schema("link string").parquet(f"{base}/out")


@query(
    "stream_failed_windows",
    "SELECT 'd' || doc_id AS raw_name, CAST(max(quality * 500 + toxic * 1000) AS BIGINT) AS failed_window FROM labels GROUP BY 1",
)
def stream_failed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of failed output windows, kept by a stream of failures that
    arrives in files; a smaller window never replaces a larger one."""
    base = scratch_dir(spark, "windows")
    labels = views.table(spark, sf_dir, "labels")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("raw_name")
    full = F.col("quality") * 500 + F.col("toxic") * 1000
    both = F.explode(F.array(full.cast("long"), F.floor(full / 2).cast("long"))).alias("failed_window")
    labels.repartition(3).select(name, both).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(registry.WINDOW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    registry.uncleanable(stream, f"{base}/state", f"{base}/cp").awaitTermination()
    return registry.current(spark, f"{base}/state", registry.WINDOW_SCHEMA)


@query(
    "stream_failed_sizes",
    "SELECT 'd' || doc_id AS raw_name, n_chars AS raw_bytes FROM documents JOIN labels USING (doc_id)",
)
def stream_failed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of failed sizes; the latest record of a file counts."""
    base = scratch_dir(spark, "sizes")
    docs = views.table(spark, sf_dir, "documents").join(views.table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("raw_name")
    steps = F.explode(F.array(F.lit(1), F.lit(2)))
    rows = docs.select(name, "n_chars", steps.alias("seq")).select(
        "raw_name", (F.col("n_chars") * F.when(F.col("seq") == 2, 1).otherwise(3)).alias("raw_bytes"),
        F.lit("empty text").alias("reason"), F.col("seq").cast("long").alias("seq"),
    )
    rows.repartition(3).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(registry.SIZE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    registry.unextractable(stream, f"{base}/state", f"{base}/cp").awaitTermination()
    return registry.current(spark, f"{base}/state", registry.SIZE_SCHEMA).select("raw_name", "raw_bytes")


@query(
    "stream_new_files",
    "SELECT source AS channel, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1",
)
def stream_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are processed once: a second run takes only what arrived since."""
    base = scratch_dir(spark, "arrivals")
    schema = "doc_id long, source string, n_chars long"
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    for part in (F.col("source") < "src15", F.col("source") >= "src15"):
        docs.where(part).write.mode("append").parquet(f"{base}/in")
        seen.process_new_files(
            spark, f"{base}/in", schema, lambda s: s.withColumnRenamed("source", "channel"), f"{base}/out", f"{base}/cp"
        ).awaitTermination()
    out = spark.read.schema("doc_id long, channel string, n_chars long").parquet(f"{base}/out")
    return out.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query(
    "snapshot_runs",
    with_(*THEMES) + """, picked AS (SELECT 'term' AS kind, term FROM
  (SELECT term FROM found WHERE NOT contains(term, ' ') ORDER BY score DESC, term LIMIT 50)
  UNION ALL SELECT 'phrase', term FROM (SELECT term FROM found WHERE contains(term, ' ') AND document_frequency >= 2
    ORDER BY document_frequency DESC, score DESC, term LIMIT 30))
  SELECT run_day, kind, term FROM picked, (VALUES ('2024-02-29'), ('2024-03-01')) d(run_day)""",
)
def snapshot_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top terms and phrases stored under two run days, the second day run twice, and read back."""
    found = materialize(tfidf.entries(reports.theme_weights(_docs(spark, sf_dir), "doc_id")), "themes")
    path = scratch_dir(spark, "snapshots")
    for day in ("2024-02-29", "2024-03-01", "2024-03-01"):
        writers.write_snapshot(tfidf.top_terms(found, 50), tfidf.top_phrases(found, 30, 2), day, path)
    return spark.read.schema("kind string, term string, run_day string").parquet(path).select("run_day", "kind", "term")


_RUN_DAYS = "(VALUES ('2024-02-29'), ('2024-03-01')) d(run_day)"


@query(
    "published_runs",
    with_(*THEMES) + f""", picked AS (SELECT 'terms' AS stored, term AS name, 0 AS n FROM
  (SELECT term FROM found WHERE NOT contains(term, ' ') ORDER BY score DESC, term LIMIT 50)
  UNION ALL SELECT 'phrases', term, 0 FROM (SELECT term FROM found WHERE contains(term, ' ') AND document_frequency >= 2
    ORDER BY document_frequency DESC, score DESC, term LIMIT 30)
  UNION ALL SELECT 'index', channel, count(*) FROM corpus GROUP BY channel)
  SELECT run_day, stored, name, CAST(n AS BIGINT) AS n FROM picked, {_RUN_DAYS}""",
)
def published_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index, terms and phrases of two runs, each published as a whole; a third run that
    ends before its last table leaves no trace in what readers see."""
    runs = Runs(spark, scratch_dir(spark, "published"))
    found = materialize(tfidf.entries(reports.theme_weights(_docs(spark, sf_dir), "doc_id")), "themes")
    for day in ("2024-02-29", "2024-03-01", "2024-03-02"):
        run = runs.begin(day)
        run.write("index", views.corpus(spark, sf_dir).drop("text"), ["channel"])
        run.write("terms", tfidf.top_terms(found, 50).select("term"))
        if day < "2024-03-02":
            run.write("phrases", tfidf.top_phrases(found, 30, 2).select("term"))
            run.publish()
    out = None
    for day in runs.names():
        index = runs.table("index", day).groupBy(F.col("channel").alias("name")).agg(F.count(F.lit(1)).alias("n"))
        listed = [("terms", runs.table("terms", day)), ("phrases", runs.table("phrases", day))]
        rows = index.select(F.lit("index").alias("stored"), "name", "n")
        for stored, held in listed:
            rows = rows.unionByName(held.select(F.lit(stored).alias("stored"), F.col("term").alias("name"), F.lit(0).cast("long").alias("n")))
        rows = rows.select(F.lit(day).alias("run_day"), "stored", "name", "n")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("stored_index", with_(CORPUS) + "SELECT channel, count(*) AS n, count(*) FILTER (has_summary) AS with_summary FROM corpus GROUP BY 1")
def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index written by channel, read back by channel."""
    path = scratch_dir(spark, "index")
    writers.write_index(views.corpus(spark, sf_dir).drop("text"), path)
    back = spark.read.parquet(path).withColumn("channel", F.col("channel").cast("string"))
    return back.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("has_summary")).alias("with_summary"))


@query(
    "stored_reports",
    with_(CORPUS) + "SELECT CAST(upload_date AS VARCHAR) AS day, channel, count(*) AS n FROM corpus GROUP BY 1, 2",
)
def stored_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sorted report table written as JSON and read back."""
    rows = views.corpus(spark, sf_dir).groupBy(F.col("upload_date").cast("string").alias("day"), "channel").agg(
        F.count(F.lit(1)).alias("n")
    )
    path = scratch_dir(spark, "report")
    writers.write_report(rows, path, ["day", "channel"])
    return spark.read.schema("day string, channel string, n long").json(path)


@query("repetition_models")
def repetition_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated classifiers on the looped cues."""
    return training.score_models(training.labelled_cues(spark, sf_dir))


@query(
    "repetition_labels",
    with_(*LOOPED, *_runs_sql("cues", "conv_id, turn")) + """SELECT (conv_id + turn) % 5 = 0 AS looped, count(*) AS n, count(h) AS n_hit FROM cues c
  LEFT JOIN (SELECT conv_id, turn, true AS h FROM h2 GROUP BY 1, 2) USING (conv_id, turn) GROUP BY 1""",
)
def repetition_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the built features agree with the labels."""
    rows = training.labelled_cues(spark, sf_dir)
    return rows.groupBy((F.col("label") == 1.0).alias("looped")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("repetitions") > 0).alias("n_hit")
    )



