"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch

#: Texts are handed to the word-level code in groups of about this many characters.
GROUP_CHARS = 1 << 19
#: Rows up to which a list of ids is broadcast; beyond, it is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null text as empty; every other column goes."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def importable(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package, wherever the driver was started."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def first_by_hash(rows: DataFrame, id_col: str, n: int) -> DataFrame:
    """At most ``n`` rows, the first by hash of the id.

    Rows that cannot be among them go before the sort, so the tasks together hand the
    driver little more than ``n`` rows, however many tasks there are.
    """
    place = F.pmod(F.xxhash64(id_col), F.lit(1 << 40))
    share = min(1.0, (1.2 * n + 100) / max(1, rows.count()))
    return rows.withColumn("_place", place).where(F.col("_place") <= int(share * (1 << 40))).orderBy("_place", id_col).limit(n).drop("_place")


def groups(batch: pa.RecordBatch, column: str = "text", limit: int = GROUP_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch whose texts have about ``limit`` characters together."""
    texts = batch.column(batch.schema.get_field_index(column))
    start, size = 0, 0
    out: list[str] = []
    for i in range(batch.num_rows):
        text = texts[i].as_py() or ""
        out.append(text)
        size += len(text)
        if size >= limit:
            yield batch.slice(start, i + 1 - start), out
            start, size, out = i + 1, 0, []
    if out:
        yield batch.slice(start), out


def words_of(text: str) -> list[bytes]:
    """Words between ``[\\x20\\x09-\\x0D]+``, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def skew_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int, shares: int = 1000) -> DataFrame:
    """Inner join on ``key`` where ``right`` has one row per key, and in ``weight`` how
    many rows ``left`` has of it.

    Keys with more than a ``shares``-th of all rows are at most ``shares`` in number,
    whatever the input, so their right rows are broadcast; the others meet by shuffle,
    where no key can be large.
    """
    large = F.col(weight) * shares > total
    hot = F.broadcast(right.where(large))
    rest = left.join(F.broadcast(right.where(large).select(key)), key, "left_anti")
    return left.join(hot, key).unionByName(rest.join(right.where(~large), key))


def checked(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has few rows; as it is otherwise."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids``; rows with a null id stay."""
    return docs.join(checked(ids.select(id_col)), id_col, "left_anti").select(docs.columns)


def without_rows(docs: DataFrame, rejected: Callable[[DataFrame], DataFrame], id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` but those that ``rejected`` names, columns as they were.

    ``rejected`` takes documents and returns rows with the ids of those that go.  Where an
    id is null or repeats, every row gets a key in its place, in the order of ids, nulls
    last, and of rows; so every row is judged by its own text, and the smallest id of a
    group still comes first.  The keys are made from the ids alone, in a distributed sort.
    """
    counts = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
    if counts.where((F.col("_n") > 1) | F.col(id_col).isNull()).isEmpty():
        return without(docs, rejected(docs), id_col)
    scratch = Scratch(docs.sparkSession, "rows")
    row = "_row"
    while row in docs.columns or "_" + row in docs.columns:
        row = "_" + row
    key = "_" + row
    rows = scratch.save(docs.withColumn(row, F.monotonically_increasing_id()), "rows", compression="zstd")
    order = rows.select(id_col, row).orderBy(F.col(id_col).asc_nulls_last(), row).select(row, F.monotonically_increasing_id().alias(key))
    keyed = scratch.save(rows.join(scratch.save(order, "order"), row).drop(row), "keyed", compression="zstd")
    gone = rejected(keyed.withColumn(id_col, F.col(key)).drop(key)).select(F.col(id_col).alias(key))
    return keyed.join(checked(gone), key, "left_anti").select(docs.columns)


class Memo:
    """Memo of two generations of about ``limit`` bytes each; the older one is dropped when the younger is full."""

    #: What an entry takes beside its bytes: two objects and its place in a table that is up to two thirds empty.
    ENTRY = 220

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.young, self.old, self.size = {}, {}, 0

    def get(self, keys: Iterable, make) -> dict:
        """A dict with the values of ``keys``, among others; ``make`` takes the list of missing keys and returns their values."""
        young, old = self.young, self.old
        missing = [k for k in set(keys) if k not in young]
        if not missing:
            return young
        found = {k: old[k] for k in missing if k in old} if old else {}
        rest = [k for k in missing if k not in found]
        if rest:
            found.update(zip(rest, make(rest)))
        young.update(found)
        self.size += self.ENTRY * len(found) + sum(map(len, found)) + sum(len(v) for v in found.values() if isinstance(v, bytes))
        if self.size >= self.limit:
            self.old, self.young, self.size = young, {}, 0
        return young


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(vid, comp) of every vertex of (a, b), ``comp`` the smallest vertex it reaches.

    Each round hangs every vertex below its smallest neighbour and draws the edges between
    what they hang below, until no edge is left.  Hubs and large components are joined by
    ``skew_join``, so neither puts its edges or members into one task.
    """
    left = scratch.save(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    n_edges = left.count()
    while n_edges:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = scratch.save(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select(F.col("a").alias("v"), F.least("a", "m").alias("p"), "n"), "parents")
        if labels is None:
            labels = parent.select(F.col("v").alias("vid"), F.col("p").alias("comp"))
        else:
            members = labels.groupBy(F.col("comp").alias("v")).agg(F.count("*").alias("members"))
            above = scratch.save(members.join(parent.select("v", "p"), "v", "left").select(F.col("v").alias("comp"), F.coalesce("p", "v").alias("up"), "members"), "above")
            labels = scratch.save(skew_join(labels, above, "comp", "members", labels.count()).select("vid", F.col("up").alias("comp")), "labels")
        up = skew_join(left, parent.select(F.col("v").alias("a"), F.col("p").alias("up_a"), "n"), "a", "n", 2 * n_edges).select("up_a", "b")
        up = skew_join(up, parent.select(F.col("v").alias("b"), F.col("p").alias("up_b"), "n"), "b", "n", 2 * n_edges).select("up_a", "up_b").where("up_a <> up_b")
        left = scratch.save(up.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct(), "edges")
        n_edges = left.count()
    if labels is None:
        return left.select(F.col("a").alias("vid"), F.col("b").alias("comp"))
    return labels
