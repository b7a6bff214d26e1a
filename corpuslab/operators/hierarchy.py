"""Folder paths by parent links, and leaf export rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_dirname
from ..functions.urls import with_timestamp
from ..session import materialize
from .matching import left_join_known
from .running import running_number

MAX_DEPTH = 20
# Collections without a folder.
SPECIAL = {-1: "Unsorted", -99: "Trash"}


def folder_paths(nodes: DataFrame) -> DataFrame:
    """(id, title, parent_id) to (id, path): titles root to leaf joined by
    ``->``.

    Ancestors double at each step (1, 2, 4, 8, 16), so the depth limit of 20
    takes five joins, fewer if all chains end before.  Each step is stored, so
    the next one reads it and not the steps before.  The chain is cut at the
    limit and at the first node that repeats, which ends cycles.
    """
    chain = nodes.select(
        "id", F.array(F.struct("id", "title")).alias("chain"), F.col("parent_id").alias("next")
    )
    chain, reach = materialize(chain, "chains"), 1
    while reach < MAX_DEPTH and not chain.where("next IS NOT NULL").isEmpty():
        up = chain.select(F.col("id").alias("next"), F.col("chain").alias("__up"), F.col("next").alias("__next"))
        # finished chains have no next node and leave the join
        joined = left_join_known(chain, up, "next")
        chain = joined.select(
            "id",
            F.when(F.col("__up").isNull(), F.col("chain")).otherwise(F.concat("chain", "__up")).alias("chain"),
            F.col("__next").alias("next"),
        )
        chain = materialize(chain, "chains")
        reach *= 2
    ids = F.transform("chain", lambda s: s["id"])
    repeats = F.filter(
        F.sequence(F.lit(1), F.size("chain")),
        lambda i: (i > 1) & F.array_contains(F.slice(ids, F.lit(1), i - 1), F.get(ids, i - 1)),
    )
    length = F.least(F.coalesce(F.get(repeats, F.lit(0)) - 1, F.size("chain")), F.lit(MAX_DEPTH))
    titles = F.transform(F.slice("chain", F.lit(1), length), lambda s: s["title"])
    return chain.select("id", F.array_join(F.reverse(titles), "->").alias("path"))


def with_paths(items: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """Add ``path`` to items by collection id; special and unknown ids get
    their own labels."""
    special = F.col(key).isin(*SPECIAL)
    placed = left_join_known(items.where(~F.coalesce(special, F.lit(False))), folder_paths(nodes).withColumnRenamed("id", key), key)
    joined = placed.unionByName(items.where(special), allowMissingColumns=True)
    label = F.coalesce("path", F.concat(F.lit("Unknown("), F.col(key).cast("string"), F.lit(")")))
    for ident, name in SPECIAL.items():
        label = F.when(F.col(key) == ident, F.lit(name)).otherwise(label)
    return joined.withColumn("path", label)


def leaves(nodes: DataFrame) -> DataFrame:
    """Nodes without children."""
    return nodes.where(F.size("children_ids") == 0)


def number_leaves(found: DataFrame, key: str, position: str) -> DataFrame:
    """Leaf number from 1 per transcript; ``position`` is an integer that is
    unique per transcript and follows (from_idx, to_idx, node_id)."""
    return running_number(found, [key], position, "leaf_index")


def citations(texts: DataFrame) -> DataFrame:
    """Export rows: citation key, folder-safe title, link with time, JSON.

    Needs title, url, channel, upload_date, leaf_index, node_id, from_idx,
    to_idx, node_start_ms.
    """
    folder = safe_dirname("title")
    leaf = F.concat(F.lit("leaf_"), F.lpad(F.col("leaf_index").cast("string"), F.greatest(F.lit(3), F.length(F.col("leaf_index").cast("string"))), F.lit("0")))
    link = with_timestamp(F.col("url"), F.floor(F.col("node_start_ms") / 1000).cast("long"))
    out = texts.withColumns({"folder": folder, "leaf": leaf, "link": link})
    out = out.withColumn("citation_key", F.concat_ws("_", "folder", "leaf"))
    body = F.to_json(
        F.struct(
            "citation_key",
            F.lit("youtube").alias("source_type"),
            F.struct("title", F.col("link").alias("url")).alias("common"),
            F.struct(
                "channel", "upload_date", "node_id", "leaf_index",
                F.col("from_idx").alias("start_entry_idx"), F.col("to_idx").alias("end_entry_idx_exclusive"),
            ).alias("source_data"),
        )
    )
    return out.withColumn("citation", body)
