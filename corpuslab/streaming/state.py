"""Keyed tables that batches keep up to date, in hash buckets."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import manifests

#: Buckets of a new table; a stored table keeps the number it began with.  A bucket is written by one task.
BUCKETS = 64
#: Appended parts of a bucket before the next append rewrites it as one.
PARTS = 8


class KeyedState:
    """The newest published version of a keyed table below ``path``.

    A batch reads and writes only the buckets its keys fall into, and becomes visible with
    its manifest, which names the parts of every bucket.  The number of a manifest is that
    of its batch, so a batch that runs again sees that it is done (``done``).  The version
    before the newest stays for readers that have begun on it; older ones are removed.

    Null is a key like any other.  Rows of one key stay in one bucket; a key has one row
    (or few), so no bucket is hot.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        found = manifests.numbers(spark, self.path)
        self.number = found[-1] if found else None
        content = manifests.load(spark, self.path, found[-1]) if found else {"buckets": buckets, "parts": {}}
        self.buckets: int = content["buckets"]
        self.parts: dict[str, list[str]] = content["parts"]

    def done(self, number: int) -> bool:
        return self.number is not None and number <= self.number

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[str]:
        """The buckets of the keys of ``rows``, at most ``buckets`` of them."""
        return [str(r["b"]) for r in rows.select(self._bucket().alias("b")).distinct().collect()]

    def rows(self, touched: list[str] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        wanted = self.parts if touched is None else [b for b in touched if b in self.parts]
        paths = [f"{self.path}/{part}/bucket={b}" for b in wanted for part in self.parts[b]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """One row of each key that the table lacks."""
        first = rows.dropDuplicates([self.key])
        held = self.rows(self.touched(rows)).select(F.col(self.key).alias("__held"))
        return first.join(held, F.col(self.key).eqNullSafe(F.col("__held")), "left_anti")

    def append(self, rows: DataFrame, number: int) -> None:
        """Add rows whose keys the table lacks."""
        touched = self.touched(rows)
        full = [b for b in touched if len(self.parts.get(b, [])) >= PARTS]
        held = rows.unionByName(self.rows(full)) if full else rows
        part = self._write(held, number) if touched else None
        after = {b: [part] if b in full else [*self.parts.get(b, []), part] for b in touched}
        self._commit({**self.parts, **after}, number)

    def upsert(self, rows: DataFrame, number: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Replace the touched buckets by ``merge(their rows, rows)``."""
        touched = self.touched(rows)
        part = self._write(merge(self.rows(touched), rows), number) if touched else None
        self._commit({**self.parts, **{b: [part] for b in touched}}, number)

    def _write(self, rows: DataFrame, number: int) -> str:
        part = f"part={number}-{uuid.uuid4().hex[:12]}"
        placed = rows.withColumn("bucket", self._bucket()).repartition("bucket")
        placed.write.partitionBy("bucket").parquet(f"{self.path}/{part}")
        return part

    def _commit(self, parts: dict[str, list[str]], number: int) -> None:
        earlier = [n for n in manifests.numbers(self.spark, self.path) if n != self.number]
        manifests.publish(self.spark, self.path, number, {"buckets": self.buckets, "parts": parts})
        live = {(part, b) for version in (self.parts, parts) for b, held in version.items() for part in held}
        for n in earlier:
            old = manifests.load(self.spark, self.path, n)["parts"]
            for part, b in {(part, b) for b, held in old.items() for part in held} - live:
                manifests.remove(self.spark, f"{self.path}/{part}/bucket={b}")
            manifests.withdraw(self.spark, self.path, n)
        self.number, self.parts = number, parts
