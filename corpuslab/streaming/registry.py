"""Keyed registries kept up to date from a stream of failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.budget import upsert_failed_windows
from .seen import first_number
from .state import BUCKETS, KeyedState

WINDOW_SCHEMA = "raw_name string, failed_window long"
SIZE_SCHEMA = "raw_name string, raw_bytes long, reason string, seq long"


def latest_sizes(rows: DataFrame) -> DataFrame:
    """The last recorded size and reason per file."""
    last = F.max_by(F.struct("raw_bytes", "reason", "seq"), F.col("seq")).alias("__l")
    return rows.groupBy("raw_name").agg(last).select("raw_name", "__l.*")


def _upsert(stream: DataFrame, path: str, checkpoint: str, schema: str, merge, buckets: int) -> StreamingQuery:
    """Each batch rewrites the buckets of its own files."""
    first = first_number(stream.sparkSession, path, checkpoint)
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def step(batch: DataFrame, batch_id: int) -> None:
        state = KeyedState(batch.sparkSession, path, schema, "raw_name", buckets)
        if not state.done(first + batch_id):
            state.upsert(batch.select(*names), first + batch_id, merge)

    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def uncleanable(stream: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Failed output windows per file; a recorded window never shrinks."""
    return _upsert(stream, path, checkpoint, WINDOW_SCHEMA, upsert_failed_windows, buckets)


def unextractable(stream: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Failed sizes per file; the last one counts."""
    return _upsert(stream, path, checkpoint, SIZE_SCHEMA, lambda old, new: latest_sizes(old.unionByName(new)), buckets)


def current(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest version of a registry."""
    return KeyedState(spark, path, schema, "raw_name").rows()
