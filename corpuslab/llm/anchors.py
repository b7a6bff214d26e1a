"""SimHash near-duplicates: fingerprints meet at the words of a covering code.

The code is the direct sum of two perfect Golay codes (23 bits, covering radius 3) and,
on the last 18 bits, the code of one word, which every fingerprint is near.  Two
fingerprints that differ in ``t`` bits have a word between them that is ``(t + 1) // 2``
bits from either at most; its nearest anchor lies, in each part, within the covering
radius plus the bits spent in that part.  So each fingerprint goes to every anchor whose
distances exceed the radii by ``(t + 1) // 2`` in sum, which is less than radius plus
threshold, and linked fingerprints always meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import connected, groups, id_and_text, skew_join, words_of

SHINGLE, SEED = 3, 42
THRESHOLD = 3
#: Generator of the Golay code, its length, check bits and covering radius (fixed values).
GOLAY, LENGTH, CHECKS, RADIUS = 0b110001110101, 23, 11, 3
#: Members of an anchor that are compared together, and the share of all copies from which an anchor is dealt over several tasks.
BLOCK, HOT_SHARE = 1 << 14, 1 << 16
#: One of so many fingerprints tells how full an anchor is.  It decides only over how many tasks the anchor is dealt.
LOOK = 64
#: Buckets up to this size are compared side by side, row against later row.
SMALL = 8
FLUSH_ROWS = 1 << 17
BITS = 64


def fingerprints(texts: list[str], size: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64): a bit is 1 where more than half of the shingles' hashes have it; 0 without words."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        words = words_of(text)
        n = len(words) - size + 1
        if not words:
            continue
        if n < 2:
            out[i] = xxhash.xxh64_intdigest(b" ".join(words), SEED)
            continue
        flat = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
        stops = ends[size - 1 :].tolist()
        counts = np.zeros(BITS, np.int64)
        for at in range(0, n, 1 << 16):
            h = np.array([xxhash.xxh64_intdigest(flat[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])], "<u8")
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * counts > n, bitorder="little").view("<u8")[0]
    return out


class Golay:
    """For every syndrome the error patterns of each excess over the covering radius, padded with -1."""

    def __init__(self, most: int):
        self.bytes = [np.array([self.divide(b << shift) for b in range(256 if shift < 16 else 1 << (LENGTH - 16))], np.int64) for shift in (0, 8, 16)]
        found: list[list[list[int]]] = [[[] for _ in range(1 << CHECKS)] for _ in range(most + 1)]
        for weight in range(RADIUS + most + 1):
            excess = max(0, weight - RADIUS)
            for places in combinations(range(LENGTH), weight):
                pattern = sum(1 << p for p in places)
                found[excess][self.syndrome_of(pattern)].append(pattern)
        self.patterns = []
        for lists in found:
            table = np.full((1 << CHECKS, max(map(len, lists))), -1, np.int64)
            for s, patterns in enumerate(lists):
                table[s, : len(patterns)] = patterns
            self.patterns.append(table)

    @staticmethod
    def divide(word: int) -> int:
        for p in range(LENGTH - 1, CHECKS - 1, -1):
            if word >> p & 1:
                word ^= GOLAY << (p - CHECKS)
        return word

    def syndrome_of(self, word: int) -> int:
        return int(self.bytes[0][word & 255] ^ self.bytes[1][word >> 8 & 255] ^ self.bytes[2][word >> 16])

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        return self.bytes[0][words & 255] ^ self.bytes[1][words >> 8 & 255] ^ self.bytes[2][words >> 16]


_codes: dict[int, Golay] = {}


def anchors_of(fps: np.ndarray, spend: int) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``fps``, anchor) of all anchors whose parts exceed the covering radius by ``spend`` bits in sum at most."""
    if spend not in _codes:
        _codes[spend] = Golay(spend)
    code = _codes[spend]
    mask = np.uint64((1 << LENGTH) - 1)
    one, two = (fps & mask).astype(np.int64), (fps >> np.uint64(LENGTH) & mask).astype(np.int64)
    s1, s2 = code.syndromes(one), code.syndromes(two)
    at, found = [], []
    for a in range(spend + 1):
        first = code.patterns[a][s1]
        c1 = np.where(first >= 0, first ^ one[:, None], -1)
        for b in range(spend + 1 - a):
            second = code.patterns[b][s2]
            c2 = np.where(second >= 0, second ^ two[:, None], -1)
            ok = (c1[:, :, None] >= 0) & (c2[:, None, :] >= 0)
            i = np.nonzero(ok)
            at.append(i[0])
            found.append((c1[i[0], i[1]] << LENGTH) | c2[i[0], i[2]])
    return np.concatenate(at), np.concatenate(found)


def bucket_edges(fps: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Edges from one member to each other one of every component of a bucket: whoever is found looks for those not found yet."""
    left = np.unique(fps)
    out = []
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= threshold
            if near.any():
                new = left[near]
                queue.extend(new)
                out += [(root, x) for x in new]
                left = left[~near]
    return out


def sorted_edges(bucket: np.ndarray, fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) between rows of equal ``bucket``; rows come sorted by it."""
    start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    size = np.diff(np.append(start, len(bucket)))
    of = np.repeat(size, size)
    a, b = [], []
    small = np.flatnonzero((of > 1) & (of <= SMALL))
    group, value = bucket[small], fps[small]
    for lag in range(1, SMALL):
        x, y = value[:-lag], value[lag:]
        near = (group[:-lag] == group[lag:]) & (x != y) & (np.bitwise_count(x ^ y) <= threshold)
        a.append(x[near])
        b.append(y[near])
    for i in np.flatnonzero(size > SMALL):
        found = bucket_edges(fps[start[i] : start[i] + size[i]], threshold)
        if found:
            pairs = np.array(found, np.uint64)
            a.append(pairs[:, 0])
            b.append(pairs[:, 1])
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def linked(distinct: DataFrame, scratch: Scratch, threshold: int = THRESHOLD) -> DataFrame:
    """(a, b): links between the ``fp`` of ``distinct``, enough of them to connect what is connected."""
    spend = (threshold + 1) // 2

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fps), 2048):
                at, anchor = anchors_of(fps[i : i + 2048], spend)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fps[i : i + 2048][at].view(np.int64))], ["anchor", "fp"])

    def copies(rows: DataFrame) -> DataFrame:
        return rows.select("fp").mapInArrow(replicate, "anchor long, fp long")

    # a look at some fingerprints tells which anchors are full; their members are compared block by block in several tasks
    look = scratch.save(copies(distinct.where(F.pmod(F.xxhash64("fp"), F.lit(LOOK)) == 0)).groupBy("anchor").agg(F.count("*").alias("n")), "look")
    seen = look.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(BLOCK // LOOK, -(-seen // HOT_SHARE))
    full = look.where(F.col("n") >= least).select("anchor", F.ceil(F.col("n") * LOOK / BLOCK).cast("int").alias("blocks"))
    rows = copies(distinct).join(F.broadcast(full), "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    rows = rows.select("anchor", "fp", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    # a bucket is an anchor and two of its blocks, as one number
    bucket = F.when((F.col("block") == 0) & (F.col("other") == 0), F.col("anchor")).otherwise(F.xxhash64("anchor", F.least("block", "other"), F.greatest("block", "other")))
    dealt = rows.select(bucket.alias("bucket"), "fp").repartition("bucket").sortWithinPartitions("bucket")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(last: bool) -> Iterator[pa.RecordBatch]:
            bucket, fps = (np.concatenate(x) for x in zip(*held))
            cut = len(bucket) if last else int(np.searchsorted(bucket, bucket[-1]))
            held[:] = [] if last else [(bucket[cut:], fps[cut:])]
            if cut > 1:
                a, b = sorted_edges(bucket[:cut], fps[:cut], threshold)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if sum(len(x[0]) for x in held) >= FLUSH_ROWS and held[0][0][0] != held[-1][0][-1]:
                yield from out(False)
        if held:
            yield from out(True)

    return dealt.mapInArrow(compare, "a long, b long")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Texts are cut into words at ``[\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fingerprints of
    64 bits are the majority of the XXH64 of all word ``size``-grams, repeats included.
    Fingerprints link at ``threshold`` or fewer differing bits; ``component_id`` is the
    smallest id that links lead to.

    Null and texts without words have fingerprint zero, which links like any other; texts
    of fewer words are one shingle.  Repeated rows and texts of equal fingerprint are one
    vertex, so they are never paired, however many they are.  A bit that exactly half of
    the shingles have is 0.  A null id is a ``component_id`` only where all ids of the
    component are null.  A text is taken whole by one task.  Other columns are left out,
    an empty table gives no rows.
    """
    if size < 1 or not 0 <= threshold <= 6:
        raise ValueError("size must be at least 1 and threshold from 0 to 6")
    scratch = Scratch(docs.sparkSession, "simhash")
    d = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in groups(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints(texts, size).view(np.int64))], ["doc_id", "fp"])

    full = scratch.save(d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, fp long"), "fingerprints")
    vertices = scratch.save(full.groupBy("fp").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")), "vertices")
    labels = connected(scratch.save(linked(vertices.select("fp"), scratch, threshold), "links"), scratch)
    comp = vertices.join(labels.withColumnRenamed("vid", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    least = comp.groupBy("comp").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members"))
    named = scratch.save(skew_join(comp, least, "comp", "members", vertices.count()).select("fp", "copies", "component_id"), "named")
    out = skew_join(full, named, "fp", "copies", full.count())
    return out.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")
