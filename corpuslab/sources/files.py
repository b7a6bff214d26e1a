"""File sources: text trees, metadata JSON, CSV, listings, inbox lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_ws
from ..session import materialize

TIMESERIES_COLUMNS = ["channelid", "datetime", "videotitle", "videoduration_minutes", "videoid"]
TIMESERIES_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c == "videoduration_minutes" else T.StringType()) for c in TIMESERIES_COLUMNS]
)
PREDICTION_COLUMNS = ["Script", "Expected", "Predicted", "Match", "Error"]


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def text_files(spark: SparkSession, folder: str, suffix: str, recursive: bool = True) -> DataFrame:
    """Whole text files as (path, name, text), sidecars left out.

    Empty files give no row; ``inventory`` lists them.
    """
    rows = (
        spark.read.option("pathGlobFilter", f"*{suffix}")
        .text(folder, wholetext=True, recursiveFileLookup=recursive)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )
    named = rows.withColumn("name", file_name(F.col("path")))
    return named.where(~F.col("name").startswith("._")).select("path", "name", "text")


def ordered_lines(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """Lines of all text files below ``folder`` with their places: ``path, folder, name, line_number, position, line``.

    ``line_number`` counts from 1 in the file, ``position`` over all files of one
    folder in the order of their names, as parts of a log that was rolled over.  Empty
    lines count.  Files are read in splits; a line's number is its place in its split and
    the number of lines in the splits before it, of which there is one row a split.
    Sidecars are left out, empty files give no row.
    """
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}" if suffix else "*").text(folder)
    path = F.col("_metadata.file_path")
    # a split is read by one task from its first line to its last, so the ids of its rows follow one another
    read = rows.select(path.alias("path"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"), F.col("value").alias("line"))
    read = materialize(read, "lines")
    splits = read.groupBy("path", "__block").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    splits = splits.withColumns({"name": file_name(F.col("path")), "folder": F.regexp_replace("path", "/[^/]*$", "")}).where(~F.col("name").startswith("._"))
    in_file = Window.partitionBy("path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    in_folder = Window.partitionBy("folder").orderBy("name", "__block").rowsBetween(Window.unboundedPreceding, -1)
    before = {"__file": F.coalesce(F.sum("__n").over(in_file), F.lit(0)), "__folder": F.coalesce(F.sum("__n").over(in_folder), F.lit(0))}
    placed = read.join(splits.withColumns(before).drop("__n"), ["path", "__block"])
    place = F.col("__id") - F.col("__first") + 1
    return placed.select("path", "folder", "name", (F.col("__file") + place).alias("line_number"), (F.col("__folder") + place).alias("position"), "line")


def _directly_in(path: Column, folder: str) -> Column:
    """Files of any name in the folder itself, not below it; those of the system are left out."""
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    parts = F.split(path, "/")
    return (F.element_at(parts, -2) == name) & ~F.element_at(parts, -1).rlike("^[._]")


def inbox_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Stripped non-empty lines of the files directly in the inbox, with ``path, name,
    line_number`` and ``position`` in the order of the file names and lines; the
    ``done`` and ``unprocessed`` folders below it are not entered."""
    rows = ordered_lines(spark, folder).where(_directly_in(F.col("path"), folder))
    return rows.select("path", "name", "line_number", "position", strip_ws(F.col("line")).alias("line")).where("line <> ''")


def inbox_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sha256) of the files directly in the inbox."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .where(_directly_in(F.col("path"), folder))
        .select("path", F.sha2(F.col("content"), 256).alias("sha256"))
    )


def _children(folder: str) -> list[str]:
    """Folders directly below ``folder``."""
    system, path = fs.FileSystem.from_uri(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f"{folder.rstrip('/')}/{i.base_name}" for i in found if not i.is_file)


def listed(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(folder, below, size, mtime) of every file under the folders.

    Spark's file sources leave out empty files, which the audits look for, so
    each task lists its folders itself.  No content is read.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["folder"]:
                system, path = fs.FileSystem.from_uri(folder)
                infos = [i for i in system.get_file_info(fs.FileSelector(path, recursive=True)) if i.is_file]
                yield pd.DataFrame(
                    {
                        "folder": folder,
                        "below": [i.path[len(path.rstrip("/")) + 1 :] for i in infos],
                        "size": [i.size for i in infos],
                        "mtime": [int(i.mtime.timestamp()) for i in infos],
                    }
                )

    if not folders:
        return spark.createDataFrame([], "folder string, below string, size long, mtime long")
    rows = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(
        min(len(folders), spark.sparkContext.defaultParallelism), "folder"
    )
    return rows.mapInPandas(walk, "folder string, below string, size long, mtime long")


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Listing below ``root/stage/channel/...`` without reading any content.

    The driver sees the stage and channel folders only, tasks list the files.
    """
    channels = [c for stage in _children(root) for c in _children(stage)]
    files = listed(spark, channels)
    at, parts = F.split("folder", "/"), F.split("below", "/")
    return files.select(
        F.element_at(at, -2).alias("stage"),
        F.element_at(at, -1).alias("channel"),
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/").alias("dir"),
        F.element_at(parts, -1).alias("name"),
        "size",
        "mtime",
        F.concat_ws("/", "folder", "below").alias("path"),
    )


def raw_items(spark: SparkSession, root: str) -> DataFrame:
    """Raw content items below ``root/<type>/``: name, stem, type, bytes."""
    from ..functions.urls import RAW_SUFFIX

    files = listed(spark, [f for f in _children(root) if f.rsplit("/", 1)[-1] in RAW_SUFFIX])
    rows = files.where(~F.contains("below", F.lit("/"))).select(
        F.concat_ws("/", "folder", "below").alias("path"),
        F.col("size").alias("raw_bytes"),
        F.col("below").alias("raw_name"),
        F.element_at(F.split("folder", "/"), -1).alias("content_type"),
    ).where(~F.col("raw_name").startswith("._"))
    expected = F.lit(False)
    for kind, suffix in RAW_SUFFIX.items():
        expected = expected | ((F.col("content_type") == kind) & F.col("raw_name").endswith(suffix))
    return rows.where(expected).withColumn("stem", F.regexp_replace("raw_name", r"\.[^.]*$", ""))


def pending_raw(items: DataFrame, cleaned: DataFrame, include_cleaned: bool = False) -> DataFrame:
    """Raw items without a non-empty cleaned file of the same type and stem."""
    if include_cleaned:
        return items
    done = cleaned.where("size > 0").select("content_type", "stem").distinct()
    return items.join(done, ["content_type", "stem"], "left_anti")


def timeseries_csv(spark: SparkSession, folder: str, id_to_name: DataFrame) -> DataFrame:
    """Publication rows of a written CSV; a channel id without a name labels
    itself.  A wrong header or row width fails the read."""
    rows = spark.read.csv(
        folder, schema=TIMESERIES_SCHEMA, header=True, multiLine=True, quote='"', escape='"',
        mode="FAILFAST", enforceSchema=False,
    )
    names = id_to_name.select(F.col("channel_id").alias("channelid"), F.col("channel").alias("__name"))
    return rows.join(names, "channelid", "left").select(
        F.coalesce("__name", "channelid").alias("channel"),
        F.col("channelid").alias("channel_id"),
        F.col("datetime").alias("published_at"),
        F.col("videotitle").alias("title"),
        F.col("videoduration_minutes").alias("duration_minutes"),
        F.col("videoid").alias("video_id"),
    )


def prediction_csvs(spark: SparkSession, folder: str, by_folder: bool = False) -> DataFrame:
    """One CSV per model; the file name is the model, the header is checked.

    With ``by_folder`` a model is a ``model=<name>`` folder of files instead.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in PREDICTION_COLUMNS])
    rows = spark.read.option("recursiveFileLookup", True).csv(
        folder, schema=schema, header=True, quote='"', escape='"', mode="FAILFAST", enforceSchema=False
    )
    path = F.col("_metadata.file_path")
    model = F.regexp_extract(path, "/model=([^/]+)/", 1) if by_folder else F.regexp_replace(file_name(path), r"\.csv$", "")
    return rows.select(
        model.alias("model"),
        file_name(F.col("Script")).alias("item"),
        F.col("Expected").alias("expected"),
        F.col("Predicted").alias("predicted"),
        F.col("Match").alias("match"),
        F.col("Error").alias("error"),
    )


def log_facts(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``channel_url`` and ``video_id`` read from download log lines."""
    text = strip_ws(F.col(line))
    url = strip_ws(F.regexp_extract(text, r"^\[youtube:tab\] Extracting URL:(.*)$", 1))
    ident = strip_ws(F.regexp_extract(text, r"^ERROR: \[youtube\] ([^:]*):", 1))
    return lines.withColumns({"channel_url": F.nullif(url, F.lit("")), "video_id": F.nullif(ident, F.lit(""))})


def collections_json(spark: SparkSession, path: str) -> DataFrame:
    """Exported collection records to (id, title, parent_id)."""
    schema = "_id long, title string, parent struct<`$id`: long>"
    rows = spark.read.schema(schema).json(path)
    return rows.where("_id is not null").select(
        F.col("_id").alias("id"), F.coalesce("title", F.lit("")).alias("title"), F.col("parent.$id").alias("parent_id")
    )


def bookmarks_json(spark: SparkSession, path: str) -> DataFrame:
    """Exported bookmark records to (collection_id, link)."""
    rows = spark.read.schema("collectionId long, link string").json(path)
    return rows.where("link <> '' and collectionId is not null").select(
        F.col("collectionId").alias("collection_id"), "link"
    )
