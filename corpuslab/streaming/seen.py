"""Streaming forms of the seen-set: emit each link once over all runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import manifests
from .state import BUCKETS, KeyedState


def link_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def drop_seen(links: DataFrame, key: str = "link") -> DataFrame:
    """First occurrence of every link; the checkpoint holds the seen-set."""
    return links.dropDuplicates([key])


def first_number(spark: SparkSession, path: str, checkpoint: str) -> int:
    """What a run adds to its batch numbers: one more than the version stored last when its checkpoint began.

    It is kept beside the checkpoint.  A new checkpoint, also one that replaces a lost
    one, continues behind everything stored; a batch that runs again keeps its number.
    """
    note = f"{checkpoint}-base"
    if manifests.exists(spark, checkpoint) and manifests.exists(spark, f"{note}/_SUCCESS"):
        return int(spark.read.schema("base long").json(note).first()["base"])
    stored = manifests.numbers(spark, path)
    base = stored[-1] + 1 if stored else 0
    spark.createDataFrame([(base,)], "base long").write.mode("overwrite").json(note)
    return base


def emit_unseen(
    links: DataFrame, seen_path: str, out_path: str, checkpoint: str, key: str = "link", key_type: str = "string", buckets: int = BUCKETS
) -> StreamingQuery:
    """Write links not emitted before, then add them to the seen table.

    The seen table grows only after the output is written, which is replaced as a whole by
    a batch that runs again.  A batch reads the buckets of its own links only.  A null link
    is emitted once, like any other.
    """
    base = first_number(links.sparkSession, seen_path, checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, number = batch.sparkSession, base + batch_id
        state = KeyedState(spark, seen_path, f"{key} {key_type}", key, buckets)
        if state.done(number):
            return
        target = f"{out_path}/batch_id={number}"
        fresh = state.unseen(batch)
        fresh.write.mode("overwrite").parquet(target)
        state.append(spark.read.schema(fresh.schema).parquet(target).select(key), number)

    return (
        links.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def seen_keys(spark: SparkSession, path: str, key: str = "link", key_type: str = "string") -> DataFrame:
    """All keys emitted so far."""
    return KeyedState(spark, path, f"{key} {key_type}", key).rows()


def process_new_files(
    spark: SparkSession, folder: str, schema: str, transform, out_path: str, checkpoint: str, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Process files that arrived since the last run; the checkpoint of the
    file source remembers what is done."""
    out = transform(spark.readStream.schema(schema).parquet(folder))
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(out_path)
