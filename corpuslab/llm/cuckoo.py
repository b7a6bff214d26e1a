"""Exact deduplication over a cuckoo-filter index of live digests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import id_and_text, skew_join

#: Runs that are not already one single space.
RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
SLOTS = 4
KICKS = 200
#: Keys that one shard of the index is sized for.
SHARD_KEYS = 50_000
INDEX = "shard int, n_buckets int, bucket int, slot int, fp int, sha binary, keep_id long, live long"


class CuckooShard:
    """Fingerprints in two possible buckets of four slots each, and beside every slot the stored key.

    A fingerprint hit is only a hint: it is verified against the keys stored in that
    bucket.  When an insertion finds no place after ``KICKS`` moves, the table is
    doubled and filled again from the stored keys, so no key is ever lost.
    """

    def __init__(self, n_buckets: int = 16):
        self.keys: list[bytes] = []
        self.ids: list[int | None] = []
        self.live: list[int] = []
        self.clear(n_buckets)

    def clear(self, n_buckets: int) -> None:
        self.n = n_buckets
        self.fp = np.zeros((n_buckets, SLOTS), np.uint16)
        self.row = np.full((n_buckets, SLOTS), -1, np.int64)
        self.turn = 0

    @staticmethod
    def fingerprint(key: bytes) -> int:
        return int.from_bytes(key[8:10], "little") or 1

    def first(self, key: bytes) -> int:
        return int.from_bytes(key[10:18], "little") & (self.n - 1)

    def other(self, bucket: int, fp: int) -> int:
        return (bucket ^ (fp * 0x5BD1E995)) & (self.n - 1)

    def find(self, key: bytes) -> int:
        """Row of a stored key, or -1.  Filter hits are verified against the content of the bucket."""
        fp, a = self.fingerprint(key), self.first(key)
        for b in {a, self.other(a, fp)}:
            for s in np.flatnonzero(self.fp[b] == fp):
                r = int(self.row[b, s])
                if self.keys[r] == key:
                    return r
        return -1

    def place(self, key: bytes, row: int) -> bool:
        fp, b = self.fingerprint(key), self.first(key)
        for at in (b, self.other(b, fp)):
            free = np.flatnonzero(self.fp[at] == 0)
            if len(free):
                self.fp[at, free[0]], self.row[at, free[0]] = fp, row
                return True
        for _ in range(KICKS):
            s, self.turn = self.turn & (SLOTS - 1), self.turn + 1
            was = int(self.fp[b, s]), int(self.row[b, s])
            self.fp[b, s], self.row[b, s] = fp, row
            fp, row = was
            b = self.other(b, fp)
            free = np.flatnonzero(self.fp[b] == 0)
            if len(free):
                self.fp[b, free[0]], self.row[b, free[0]] = fp, row
                return True
        return False

    def resize(self) -> None:
        """Double until every stored live key has a place."""
        n = self.n
        while True:
            n *= 2
            self.clear(n)
            if all(self.place(k, r) for r, k in enumerate(self.keys) if self.live[r] > 0):
                return

    def insert(self, key: bytes, doc_id: int | None, count: int = 1) -> None:
        r = self.find(key)
        if r >= 0:
            self.live[r] += count
            if doc_id is not None and (self.ids[r] is None or doc_id < self.ids[r]):
                self.ids[r] = doc_id
            return
        self.keys.append(key)
        self.ids.append(doc_id)
        self.live.append(count)
        if not self.place(key, len(self.keys) - 1):
            self.resize()

    def delete(self, key: bytes, count: int = 1) -> bool:
        """Take back ``count`` insertions; the slot is freed with the last one.  False if the key is not stored."""
        r = self.find(key)
        if r < 0:
            return False
        self.live[r] -= count
        if self.live[r] <= 0:
            self.row[self.row == r], self.fp[self.row == r] = -2, 0
            self.row[self.row == -2] = -1
        return True

    def frame(self, shard: int) -> pd.DataFrame:
        at, slot = np.nonzero(self.row >= 0)
        rows = self.row[at, slot]
        return pd.DataFrame(
            {
                "shard": np.int32(shard), "n_buckets": np.int32(self.n), "bucket": at.astype("int32"), "slot": slot.astype("int32"),
                "fp": self.fp[at, slot].astype("int32"), "sha": [self.keys[r] for r in rows],
                "keep_id": pd.array([self.ids[r] for r in rows], dtype="Int64"), "live": np.array([self.live[r] for r in rows], "int64"),
            }
        )

    @classmethod
    def load(cls, rows: pd.DataFrame) -> CuckooShard:
        out = cls(int(rows["n_buckets"].iloc[0]) if len(rows) else 16)
        out.keys = [bytes(k) for k in rows["sha"]]
        out.ids = [None if pd.isna(x) else int(x) for x in rows["keep_id"]]
        out.live = [int(x) for x in rows["live"]]
        at, slot = rows["bucket"].to_numpy("int64"), rows["slot"].to_numpy("int64")
        out.fp[at, slot] = rows["fp"].to_numpy("uint16")
        out.row[at, slot] = np.arange(len(rows))
        return out


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sha): SHA-256 of each text with white space runs as one space; null counts as empty."""
    d = id_and_text(docs, id_col, text_col)
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.regexp_replace("text", RUN, " ").cast("binary"), 256)).alias("sha"))


def partial_counts(keys: DataFrame) -> DataFrame:
    """(sha, first_id, n) per Arrow batch, so that a hot digest travels once per batch and not once per row."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            g = f.assign(doc_id=f["doc_id"].astype("Int64")).groupby("sha", sort=False)["doc_id"]
            yield pd.DataFrame({"first_id": g.min(), "n": g.size().astype("int64")}).reset_index()

    return keys.mapInPandas(count, "sha binary, first_id long, n long")


def _sharded(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("shard", F.pmod(F.conv(F.substring(F.hex("sha"), 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int"))


def build_index(keys: DataFrame, shards: int) -> DataFrame:
    """Index rows (``INDEX``) of all (doc_id, sha); one shard is one group and holds about ``SHARD_KEYS`` keys."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        shard = CuckooShard()
        for sha, first, n in zip(frame["sha"], frame["first_id"], frame["n"]):
            shard.insert(bytes(sha), None if pd.isna(first) else int(first), int(n))
        return shard.frame(int(frame["shard"].iloc[0]))

    return _sharded(partial_counts(keys), shards).groupBy("shard").applyInPandas(build, INDEX)


def update_index(index: DataFrame, shards: int, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """The index after deleting and then inserting (doc_id, sha) rows; only as many shards are touched as change.

    ``keep_id`` is the smallest id ever inserted for a digest that stayed live since.
    """
    changes = _sharded(partial_counts(inserted), shards).withColumn("sign", F.lit(1)).unionByName(_sharded(partial_counts(deleted), shards).withColumn("sign", F.lit(-1)))

    def change(key, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        shard = CuckooShard.load(old)
        for _, r in new.sort_values("sign", kind="stable").iterrows():
            if r["sign"] < 0:
                shard.delete(bytes(r["sha"]), int(r["n"]))
            else:
                shard.insert(bytes(r["sha"]), None if pd.isna(r["first_id"]) else int(r["first_id"]), int(r["n"]))
        return shard.frame(int(key[0]))

    return index.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, INDEX)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Texts are equal when identical after each run of white space became one space;
    null counts as empty.  ``keep_id`` is the smallest id of the group, ``kept`` marks
    it.  Rows with a null id count in ``group_size`` and are kept only where no id of
    their group is set (``keep_id`` is null then).  Rows that repeat an id are the same
    document and get the same values.  An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    keys = scratch.save(digests(docs, id_col, text_col), "keys")
    total = keys.count()
    shards = max(1, -(-total // SHARD_KEYS))
    index = scratch.save(build_index(keys, shards), "index")
    found = skew_join(keys, index.select("sha", "keep_id", "live"), "sha", "live", total)
    return found.select(
        "doc_id",
        "keep_id",
        F.col("live").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
