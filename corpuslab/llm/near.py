"""Near-duplicate components: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import BROADCAST_ROWS, checked, groups, id_and_text, skew_join, words_of

#: Coordinates of a band and bands.  A pair of similarity 0.8 meets in no band with probability (1 - 0.8^6)^52 < 2e-7.
ROWS, BANDS = 6, 52
COORDINATES = ROWS * BANDS
SHINGLE = 2
#: Links: ``100 * intersection >= THRESHOLD * union``.
THRESHOLD = 80
#: Edges of a hub that one task verifies.
HUB_EDGES = 256
ELEMENTS = 1 << 18
#: Members of a bucket that are compared together, members of a component in one list, and vertices that one task attaches.
BLOCK, PART, HUBS = 4096, 1 << 15, 64


def sure(threshold: int) -> int:
    """Equal coordinates below which a pair is not verified: six standard deviations under those of a pair at the threshold."""
    return int(COORDINATES * threshold / 100 - 6 * np.sqrt(COORDINATES * threshold / 100 * (1 - threshold / 100)))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word ``size``-grams; of fewer words the whole sequence, of none nothing."""
    words = words_of(text)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(size, len(h)), np.uint64)
    for j in range(min(size, len(h))):
        out = mix(out ^ h[j : j + n]) + np.uint64(0x9E3779B97F4A7C15)
    return np.unique(out)


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """(sets, t) fast similarity sketches; rows of empty sets stay at the largest value.

    In round ``i < t`` every element falls in one random bin, in round ``t + i`` in bin
    ``i``, so all bins are full after ``2 t`` rounds at the latest; a bin keeps the
    smallest (round, value).  Sets leave once all their bins are full: later rounds only
    have larger values.  Several rounds are done together when few elements are left.
    """
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(len(sets) * t, top, np.uint64)
    live = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    start = 0
    low = np.uint64((1 << 52) - 1)
    while len(live) and start < 2 * t:
        element = np.concatenate([sets[i] for i in live])
        owner = np.repeat(live, [len(sets[i]) for i in live])
        rounds = np.arange(start, min(2 * t, start + max(1, ELEMENTS // len(element))), dtype=np.uint64)
        v = mix(element[:, None] ^ mix(rounds + np.uint64(1))[None, :])
        bins = np.where(rounds < t, ((v >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32), rounds - np.uint64(t)).astype(np.int64)
        np.minimum.at(out, (owner[:, None] * t + bins).ravel(), ((rounds << np.uint64(52))[None, :] | (v & low)).ravel())
        start += len(rounds)
        live = live[(out.reshape(-1, t)[live] == top).any(1)]
    return out.reshape(-1, t)


def bands(sketch: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys of the bands."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for j in range(ROWS):
        key = mix(key ^ parts[:, :, j])
    return key.view(np.int64)


def sketched(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(row, doc_id, n_shingles, sig, bands, coords, text) of each (row, doc_id, text).

    ``sig`` names the set, null for the empty one; ``coords`` has one byte of each
    coordinate, then four of each band.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in groups(batch):
                sets = [shingles(t, size) for t in texts]
                s = sketches(sets)
                keys = bands(s)
                coords = np.concatenate([mix(s).astype(np.uint8), keys.astype("<u4").view(np.uint8)], 1)
                full = [len(x) > 0 for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(x.tobytes()) if ok else None for x, ok in zip(sets, full)], pa.binary()),
                        pa.array([k if ok else None for k, ok in zip(keys, full)], pa.list_(pa.int64())),
                        pa.array([c.tobytes() if ok else None for c, ok in zip(coords, full)], pa.binary()),
                        part.column(2),
                    ],
                    ["row", "doc_id", "n_shingles", "sig", "bands", "coords", "text"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("row", "doc_id", "text").mapInArrow(run, f"row long, doc_id {kind}, n_shingles long, sig binary, bands array<long>, coords binary, text string")


def unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES + 4 * BANDS)


def plausible(edges: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Those (a, b) whose sketches agree in enough coordinates that they may be linked."""
    one = sets.select(F.col("vid").alias("a"), F.col("coords").alias("_a"))
    two = sets.select(F.col("vid").alias("b"), F.col("coords").alias("_b"))
    both = one.join(checked(edges.select("a", "b")), "a").join(two, "b").select("a", "b", "_a", "_b")
    least = sure(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (unpacked(batch.column(j))[:, :COORDINATES] for j in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= least))

    return both.mapInArrow(run, "a long, b long")


def verified(edges: DataFrame, texts: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The (a, b) that are linked, by their full sets.

    The text of ``a`` meets those of all its partners; hubs with many of them are dealt
    over several tasks, each with a copy of the hub's text.
    """
    degree = edges.groupBy("a").agg(F.ceil(F.count("*") / HUB_EDGES).cast("int").alias("parts"))
    salted = edges.join(degree, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("vid"), F.lit(1).alias("spoke"))
    hubs = degree.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("vid"), F.lit(0).alias("spoke"))
    # ids travel to the texts while they are few enough, so texts are shuffled to their hubs only
    rows = texts.join(checked(hubs.unionByName(salted)), "vid").repartition("a", "part").sortWithinPartitions("a", "part", "spoke")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for a, vid, spoke, text in zip(*(batch.column(j).to_pylist() for j in range(4))):
                s = shingles(text, size)
                if not spoke:
                    hub, own = a, s
                    continue
                assert hub == a
                shared = len(np.intersect1d(own, s, assume_unique=True))
                if 100 * shared >= threshold * (len(own) + len(s) - shared):
                    found.append((a, vid))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.select("a", "vid", "spoke", "text").mapInArrow(run, "a long, b long")


def across(rows: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(g, part, a, partners): per vertex ``a`` and other component ``g`` the members of ``g`` that it may be linked to.

    ``rows``: key, band, vid, size, comp, parts of buckets with several components.  Each
    pair counts in the first band it shares, and no pair makes a row of its own; large
    buckets are compared block by block.
    """
    least = sure(threshold)
    blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    dealt = rows.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("vid"), F.col("n")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "band", "vid", "size", "comp", "parts").join(sets, "vid")
    dealt = dealt.select("key", "lo", "hi", "block", "band", "vid", "size", "comp", "parts", "coords").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def compare(lo: int, hi: int, block, band: int, vid, size, comp, parts, coords) -> list[tuple]:
        kinds, counts = np.unique(comp, return_counts=True)
        minor = comp != kinds[counts.argmax()]
        marks = coords[:, COORDINATES : COORDINATES + 4 * band]
        out = []
        for i in np.flatnonzero(minor):
            ok = (comp != comp[i]) & (np.minimum(size, size[i]) * 100 >= np.maximum(size, size[i]) * threshold)
            if lo != hi:
                ok &= block != block[i]
            ok &= ~minor | (vid > vid[i])  # two of the minor ones meet once
            at = np.flatnonzero(ok)
            at = at[(coords[at, :COORDINATES] == coords[i, :COORDINATES]).sum(1) >= least]
            if band and len(at):
                at = at[~(marks[at].reshape(len(at), band, 4) == marks[i].reshape(band, 4)).all(2).any(1)]
            place = vid[at] % parts[at]
            for g in np.unique(comp[at]):
                for k in np.unique(place[comp[at] == g]):
                    out.append((int(g), int(k), int(vid[i]), vid[at[(comp[at] == g) & (place == k)]].tolist()))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(group: list[tuple]) -> pa.RecordBatch:
            key = group[0][:3]
            cols = [np.array([r[j] for r in group]) for j in (3, 5, 6, 7, 8)]
            coords = np.frombuffer(b"".join([r[9] for r in group]), np.uint8).reshape(len(group), -1)
            found = compare(key[1], key[2], cols[0], int(group[0][4]), *cols[1:], coords)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([x[j] for x in found], k) for j, k in enumerate(kinds)], ["g", "part", "a", "partners"])

        group: list[tuple] = []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if group and r[:3] != group[0][:3]:
                    yield made(group)
                    group = []
                group.append(r)
        if group:
            yield made(group)

    return dealt.mapInArrow(run, "g long, part long, a long, partners array<long>")


def attached(lists: DataFrame, texts: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """A link (a, b) for each ``a`` and component ``g`` of ``lists`` that has one, by the full sets.

    Vertices with partners in one component are taken ``HUBS`` at a time, so a partner's
    text is read once for all of them.
    """
    sizes = lists.select("g", "part", "a").distinct().groupBy("g", "part").agg(F.ceil(F.count("*") / HUBS).cast("int").alias("n"))
    dealt = lists.join(sizes, ["g", "part"]).select("g", "part", F.pmod(F.xxhash64("a"), F.col("n")).cast("int").alias("hub"), "a", "partners")

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {(g, part, hub, b) for g, part, hub, _, partners in zip(*(c.to_pylist() for c in batch.columns)) for b in partners}
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in seen], k) for j, k in enumerate(kinds)], ["g", "part", "hub", "vid"])

    none = F.lit(None)
    partner = texts.join(checked(dealt.mapInArrow(wanted, "g long, part long, hub int, vid long").distinct()), "vid").select("g", "part", "hub", F.lit(2).alias("kind"), "vid", none.cast("array<long>").alias("partners"), "text")
    hubs = texts.join(checked(dealt.select("g", "part", "hub", F.col("a").alias("vid")).distinct()), "vid").select("g", "part", "hub", F.lit(1).alias("kind"), "vid", none.cast("array<long>").alias("partners"), "text")
    rows = dealt.select("g", "part", "hub", F.lit(0).alias("kind"), F.col("a").alias("vid"), "partners", none.cast("string").alias("text")).unionByName(hubs).unionByName(partner)
    rows = rows.repartition("g", "part", "hub").sortWithinPartitions("g", "part", "hub", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, of, own, done = None, {}, {}, set()
        for batch in batches:
            found = []
            for g, part, hub, kind, vid, partners, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (g, part, hub) != now:
                    now, of, own, done = (g, part, hub), {}, {}, set()
                if kind == 0:
                    for b in partners:
                        of.setdefault(b, []).append(vid)
                elif kind == 1:
                    own[vid] = shingles(text, size)
                else:
                    s = None
                    for a in of[vid]:
                        if a in done:
                            continue
                        s = shingles(text, size) if s is None else s
                        shared = len(np.intersect1d(own[a], s, assume_unique=True))
                        if 100 * shared >= threshold * (len(own[a]) + len(s) - shared):
                            found.append((a, vid))
                            done.add(a)  # one link connects it with the component
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(vid, comp) of every vertex of (a, b), ``comp`` the smallest vertex it reaches.

    Each round hangs every vertex below its smallest neighbour and draws the edges
    between what they hang below, until no edge is left.
    """
    left = scratch.save(edges.select("a", "b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = scratch.save(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("p")), "parents")
        if labels is None:
            labels = parent.select(F.col("v").alias("vid"), F.col("p").alias("comp"))
        else:
            labels = labels.join(parent, labels["comp"] == parent["v"], "left").select("vid", F.coalesce("p", "comp").alias("comp"))
        labels = scratch.save(labels, "labels")
        up = left.join(parent, left["a"] == parent["v"]).select(F.col("p").alias("a"), "b")
        up = up.join(parent, up["b"] == parent["v"]).select("a", F.col("p").alias("b")).where("a <> b")
        left = scratch.save(up.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("vid"), F.col("b").alias("comp"))
    return labels


def _alike(a: str, b: str, threshold: int):
    """Sets of these sizes can be linked."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def links(buckets: DataFrame, sets: DataFrame, texts: DataFrame, scratch: Scratch, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(vid, comp) over all links between members of a bucket.

    Stars first: every member against the first member of its bucket, in two orders;
    then, in buckets whose members are not all connected, the members of the smaller
    components against those of the others.  Pairs inside a component change nothing and
    are left out, so a large group of copies costs its size and not its square.
    """
    found = labels = None
    for pick in (F.min, F.max, None):
        if labels is None:
            rows = buckets.withColumn("comp", F.col("vid"))
        else:
            rows = buckets.join(labels, "vid", "left").withColumn("comp", F.coalesce("comp", "vid"))
            mixed = rows.groupBy("key").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi").select("key")
            rows = scratch.save(rows.join(mixed, "key").select("key", "band", "vid", "size", "comp"), "open")
            if rows.isEmpty():
                break
        if pick is None:
            parts = labels.groupBy("comp").agg(F.ceil(F.count("*") / PART).cast("long").alias("parts"))
            rows = rows.join(parts, "comp", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            good = attached(scratch.save(across(rows, sets, threshold), "lists"), texts, size, threshold)
        else:
            first = rows.groupBy("key").agg(pick(F.struct("vid", "size", "comp")).alias("x")).select("key", F.col("x.vid").alias("a"), F.col("x.size").alias("size_a"), F.col("x.comp").alias("comp_a"))
            pairs = rows.join(first, "key").where((F.col("comp") != F.col("comp_a")) & _alike("size", "size_a", threshold))
            good = verified(scratch.save(plausible(scratch.save(pairs.select("a", F.col("vid").alias("b")).distinct(), "pairs"), sets, threshold), "candidates"), texts, size, threshold)
        good = scratch.save(good, "links")
        found = good if found is None else found.unionByName(good)
        labels = components(found, scratch)
    return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Documents are linked when ``100 * |A and B| >= threshold * |A or B|`` of their sets of
    word ``size``-grams; ``component_id`` is the smallest id that links lead to.  Equal sets are taken
    as one vertex, so their copies are never paired.  Candidates share a band of their
    sketches, links are confirmed on the full sets.

    Null counts as empty; empty documents are linked with nothing, not with each other.
    A null id is never a ``component_id`` unless all ids of the component are null; then
    it is kept.  Repeated rows are copies of each other (``kept`` marks all rows of the
    kept id).  An empty table gives no rows.
    """
    if size < 1 or not THRESHOLD <= threshold <= 100:
        raise ValueError(f"size must be at least 1 and threshold from {THRESHOLD}, which the bands are made for, to 100")
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    d = id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    full = scratch.save(sketched(d, size), "sketches", compression="zstd")
    has = full.where(F.col("sig").isNotNull())
    vertices = scratch.save(has.groupBy("sig").agg(F.min("row").alias("vid"), F.count("*").alias("copies"), F.min("doc_id").alias("first_id")), "vertices")
    total = full.count()
    # one row stands for each set
    reps = full.select(F.col("row").alias("vid"), F.col("n_shingles").alias("size"), "bands").join(checked(vertices.select("vid")), "vid", "left_semi")
    keys = reps.select("vid", "size", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = scratch.save(keys.join(checked(scratch.save(shared, "shared"), 4 * BROADCAST_ROWS), "key").select("key", "band", "vid", "size"), "buckets")
    members = scratch.save(buckets.select("vid").distinct(), "members")
    wanted = full.select(F.col("row").alias("vid"), "coords", "text").join(checked(members), "vid", "left_semi")
    wanted = scratch.save(wanted, "members", compression="zstd")
    labels = links(buckets, wanted.select("vid", "coords"), wanted.select("vid", "text"), scratch, size, threshold)

    comp = vertices.join(labels, "vid", "left").withColumn("comp", F.coalesce("comp", "vid"))
    least = comp.groupBy("comp").agg(F.min("first_id").alias("component_id"), F.count("*").alias("sets"))
    n_sets = vertices.count()
    named = scratch.save(skew_join(comp, least, "comp", "sets", n_sets).select("sig", "copies", "component_id"), "named")
    linked = skew_join(has.select("doc_id", "n_shingles", "sig"), named, "sig", "copies", total).select("doc_id", "n_shingles", "component_id")
    empty = full.where(F.col("sig").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def sql() -> str:
    """The same rows from all pairs that share a shingle."""
    return r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 2 THEN ws[1] ELSE ws[i + 1] || chr(9) || ws[i + 2] END AS sh
  FROM w, unnest(range(greatest(len(ws) - 1, least(len(ws), 1)))) AS t(i)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT reach.doc_id, l.b FROM reach JOIN l ON reach.r = l.a),
m AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
