"""Prefix trie of conversations: a count-min sketch of prefix digests tells what nobody shares.

A prefix whose estimate is one is a singleton, and so are all longer ones of its
conversation: these nodes are made where they lie.  Only the others are shuffled and
grouped exactly.  Texts never move: turns become a digest and a length first.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.running import running
from ..session import Scratch
from .common import skew_join

#: A prefix of turns t1..tk is ``t1 B^(k-1) + ... + tk`` under two moduli and bases, so parts of a long conversation can be joined.
MODULUS = (1 << 61) - 1
BASES = (0x1234567890ABCDE1 % MODULUS, 0x0FEDCBA987654321 % MODULUS)
#: Rows of the sketch and cells of a row, and cells that are merged together.
DEPTH, MOST_CELLS, CHUNK = 3, 1 << 24, 1 << 16
LOCAL = ["conv", "key", "size", "part", "pos", "p1", "p2", "q1", "q2", "last"]


def facts(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, key, size): a digest of role and text, and the text's code points; turns without a conversation go."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    key = F.substring(F.unhex(F.sha2(framed.cast("binary"), 256)), 1, 16)
    return turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), key.alias("key"), F.length(text).cast("long").alias("size"))


def sequenced(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, pos, size, p1, p2, q1, q2, key, last): place from 1 by turn (null first) and key, digests of the prefix and of the
    one before it, and whether the prefix is the whole conversation.

    Rows are sorted over the cluster, so a conversation of any length is spread over
    tasks.  Tasks number and digest what they have; what came before the first
    conversation of a task, one row a task, is added afterwards.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, n, p1, p2 = None, 0, 0, 0
        (b1, b2), m = BASES, MODULUS
        held: list | None = None

        def out(following: int | None) -> pa.RecordBatch:
            convs = held[0]
            last = [a != b for a, b in zip(convs, [*convs[1:], following])]
            cols = [pa.array(convs, pa.int64()), *held[1], *(pa.array(x, pa.int64()) for x in ([part] * len(convs), *held[2])), pa.array(last)]
            return pa.RecordBatch.from_arrays(cols, LOCAL)

        for batch in batches:
            if not batch.num_rows:
                continue
            convs = batch.column(0).to_pylist()
            if held is not None:
                yield out(convs[0])
            made = [[], [], [], [], []]
            for conv, key in zip(convs, batch.column(2).to_pylist()):
                if conv != now:
                    now, n, p1, p2 = conv, 0, 0, 0
                q1, q2 = p1, p2
                n += 1
                p1 = (p1 * b1 + int.from_bytes(key[:8], "little")) % m
                p2 = (p2 * b2 + int.from_bytes(key[8:], "little")) % m
                for column, value in zip(made, (n, p1, p2, q1, q2)):
                    column.append(value)
            held = [convs, [batch.column(2), batch.column(3)], made]
        if held is not None:
            yield out(None)

    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("key").asc()]
    dealt = rows.select("conv", "turn", "key", "size").repartitionByRange(*order).sortWithinPartitions(*order)
    kept = scratch.save(dealt.mapInArrow(local, "conv long, key binary, size long, part long, pos long, p1 long, p2 long, q1 long, q2 long, last boolean"), "sorted")
    final = F.max_by(F.struct("pos", "p1", "p2"), F.struct("conv", "pos"))
    # one row to a task of the sort
    parts = sorted(kept.groupBy("part").agg(F.min("conv").alias("first"), F.max("conv").alias("last"), final.alias("end")).collect())
    before: dict[int, tuple[int, int, int, int]] = {}
    follow: dict[int, tuple[int, int]] = {}
    conv, state = None, (0, 0, 0)
    for i, r in enumerate(parts):
        n, *sums = r["end"]
        if r["first"] == conv:
            before[r["part"]] = (conv, *state)
            if r["last"] == conv:
                sums = [(s * pow(b, n, MODULUS) + e) % MODULUS for s, b, e in zip(state[1:], BASES, sums)]
                n += state[0]
        conv, state = r["last"], (n, *sums)
        if i + 1 < len(parts) and parts[i + 1]["first"] == conv:
            follow[r["part"]] = (conv, r["end"]["pos"])
    sent = rows.sparkSession.sparkContext.broadcast((before, follow))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, follow = sent.value
        for batch in batches:
            conv, part, pos, p1, p2, q1, q2, last = (batch.column(LOCAL.index(c)).to_numpy(zero_copy_only=False).copy() for c in ("conv", "part", "pos", "p1", "p2", "q1", "q2", "last"))
            for p in np.unique(part).tolist():
                if p in follow:
                    last[(part == p) & (conv == follow[p][0]) & (pos == follow[p][1])] = False
                if p in before:
                    c, n, *sums = before[p]
                    for i in np.flatnonzero((part == p) & (conv == c)).tolist():
                        k = int(pos[i])
                        for s, b, one, earlier in zip(sums, BASES, (p1, p2), (q1, q2)):
                            one[i] = (s * pow(b, k, MODULUS) + int(one[i])) % MODULUS
                            earlier[i] = (s * pow(b, k - 1, MODULUS) + int(earlier[i])) % MODULUS
                        pos[i] = k + n
            cols = [pa.array(conv), pa.array(pos), batch.column(2), *(pa.array(x) for x in (p1, p2, q1, q2)), batch.column(1), pa.array(last)]
            yield pa.RecordBatch.from_arrays(cols, ["conv", "pos", "size", "p1", "p2", "q1", "q2", "key", "last"])

    return scratch.save(kept.mapInArrow(whole, "conv long, pos long, size long, p1 long, p2 long, q1 long, q2 long, key binary, last boolean"), "sequenced")


def mix(x: np.ndarray) -> np.ndarray:
    """Mixing of uint64 (MurmurHash3's finalizer, fixed values)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def cells(pos: np.ndarray, one: np.ndarray, two: np.ndarray, width: int) -> np.ndarray:
    """(DEPTH, n) cells of the prefixes, those of row ``j`` from ``j * width`` on."""
    x = mix(one.view(np.uint64) ^ mix(two.view(np.uint64) ^ mix(pos.view(np.uint64) + np.uint64(1))))
    seeds = [np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) for j in range(DEPTH)]
    return np.stack([(mix(x + seed) % np.uint64(width)).astype(np.int64) + j * width for j, seed in enumerate(seeds)])


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Bits of the cells that count two or more; counts beyond are not needed.

    Tasks hand on the pieces that they filled, tasks merge them; the driver gets
    ``DEPTH * width / 8`` bytes at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DEPTH * width, np.uint8)
        for batch in batches:
            at, n = np.unique(cells(*(batch.column(j).to_numpy(zero_copy_only=False) for j in range(3)), width), return_counts=True)
            total[at] = np.minimum(total[at] + np.minimum(n, 2), 2)
        pieces = total.reshape(-1, CHUNK)
        for i in np.flatnonzero(pieces.any(1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i]), *(pa.array([np.packbits(pieces[i] >= k).tobytes()], pa.binary()) for k in (1, 2))], ["chunk", "one", "two"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, one, two = None, None, None
        for batch in batches:
            for chunk, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if chunk != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([two.tobytes()], pa.binary())], ["chunk", "two"])
                    now, one, two = chunk, a, b
                else:
                    one, two = one | a, two | b | (one & a)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([two.tobytes()], pa.binary())], ["chunk", "two"])

    pieces = rows.select("pos", "p1", "p2").mapInArrow(count, "chunk long, one binary, two binary")
    merged = pieces.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, "chunk long, two binary")
    bits = np.zeros((DEPTH * width // CHUNK, CHUNK // 8), np.uint8)
    for r in merged.toLocalIterator():
        bits[r["chunk"]] = np.frombuffer(r["two"], np.uint8)
    return bits.ravel()


def screened(rows: DataFrame, bits: np.ndarray, width: int) -> DataFrame:
    """``rows`` with ``shared``, whether the prefix's estimate is two or more, and ``above``, the same of the one before it."""
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            pos, p1, p2, q1, q2 = (batch.column(j).to_numpy(zero_copy_only=False) for j in (1, 3, 4, 5, 6))

            def many(*digest: np.ndarray) -> np.ndarray:
                at = cells(*digest, width)
                return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(0)

            # the root is everybody's
            cols = [*batch.columns, pa.array(many(pos, p1, p2)), pa.array((pos == 1) | many(pos - 1, q1, q2))]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names, "shared", "above"])

    kept = rows.drop("key")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, shared boolean, above boolean")


def end_lists(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv): digest of the ids in order, joined by commas.

    Ids are joined in blocks of neighbouring numbers, and the digest reads one block after
    the other, so no list is ever whole.
    """
    blocks = ends.groupBy("node", F.shiftright("conv", 12).alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = node, sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["pos", "p1", "p2", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, digest.hexdigest())], ["pos", "p1", "p2", "ends_sha256"])

    rows = blocks.repartition("node").sortWithinPartitions("node", "block").select("node.pos", "node.p1", "node.p2", "ids")
    return rows.mapInArrow(run, "pos long, p1 long, p2 long, ends_sha256 string").select(F.struct("pos", "p1", "p2").alias("node"), "ends_sha256")


def trie(rows: DataFrame, convs: DataFrame, scratch: Scratch, cells_most: int = MOST_CELLS) -> DataFrame:
    """Nodes over the sequences ``rows`` (conv, turn, key, size) of all ``convs`` (conv), which may have no row."""
    seq = sequenced(rows, scratch)
    width = CHUNK
    n = seq.count()
    while width < min(4 * n, cells_most):
        width *= 2
    known = scratch.save(screened(seq, sketch(seq, width), width), "screened")
    none = F.lit(None).cast("struct<pos:bigint,p1:bigint,p2:bigint>")
    node, parent = F.struct("pos", "p1", "p2"), F.struct((F.col("pos") - 1).alias("pos"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))

    # single nodes are ready but for the parent of the first one of a conversation
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    singles = known.where("NOT shared").select(
        "conv", F.col("pos").alias("depth"), "above", parent.alias("parent"), "last", F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("last"), digest(F.col("conv").cast("string"))).otherwise(digest(F.lit(""))).alias("ends_sha256"),
    )
    # only what may be shared is grouped
    zero = F.lit(0).cast("long")
    begun = known.where("pos = 1").select("conv", F.lit(True).alias("begun"))
    root = convs.join(begun, "conv", "left").select("conv", zero.alias("pos"), F.struct(zero.alias("pos"), zero.alias("p1"), zero.alias("p2")).alias("node"), none.alias("parent"), zero.alias("size"), F.col("begun").isNull().alias("last"))
    may = known.where("shared").select("conv", "pos", node.alias("node"), F.when(F.col("above"), parent).alias("parent"), "size", "last")
    members = scratch.save(root.unionByName(may), "members")
    grouped = members.groupBy("node").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.max("size").alias("size"), F.max("parent").alias("parent"))
    grouped = scratch.save(grouped, "grouped")
    below = grouped.select("parent").unionByName(singles.where("above").select("parent")).where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = scratch.save(grouped.join(below, "node", "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes")

    # A node belongs to its smallest member, whose prefixes are all nodes above it.  So each conversation carries what its own
    # nodes save, and its leaf if that is its own, up its prefixes; a node sums what its members carry.
    own = nodes.select("conv", F.col("node.pos").alias("pos"), (2 * (F.col("n_convs") - 1) * F.col("size") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("x"))
    tail_end = singles.where("last").select("conv", F.col("depth").alias("pos"), none.alias("node"), F.lit(1).cast("long").alias("x"))
    carried = members.select("conv", "pos", "node").join(own, ["conv", "pos"], "left").select("conv", "pos", "node", F.coalesce("x", zero).alias("x"))
    carried = scratch.save(carried.unionByName(tail_end).withColumn("order", -F.col("pos")), "carried")
    up = running(carried, ["conv"], "order", F.col("x"), "sum").where("node IS NOT NULL")
    totals = up.groupBy("node").agg(F.sum(F.shiftright("sum", 1)).alias("saved_tokens"), F.sum(F.col("sum").bitwiseAND(F.lit(1).cast("long"))).alias("n_leaves"))
    done = nodes.join(totals, "node").join(end_lists(members.where("last").select("node", "conv")), "node", "left")
    done = done.withColumns({"ends_sha256": F.coalesce("ends_sha256", digest(F.lit(""))), "depth": F.col("node.pos")})
    result = ["conv", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    done = scratch.save(done.select("parent", *result), "done")

    asking = done.where("parent IS NOT NULL").unionByName(singles.where("above").select("parent", *result))
    answers = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"), "n_children")
    total = nodes.agg(F.coalesce(F.sum("n_children"), zero)).first()[0]
    met = skew_join(asking.withColumnRenamed("n_children", "children"), answers, "parent", "n_children", total).drop("n_children").withColumnRenamed("children", "n_children")
    # nothing is above the root, and what hangs below a single node belongs to the same conversation
    rest = done.where("parent IS NULL").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv")))
    alone = singles.where("NOT above").withColumn("parent_conv_id", F.col("conv"))
    columns = [F.col("conv").alias("conv_id"), "depth", "parent_conv_id", *result[2:]]
    return met.select(*columns).unionByName(rest.select(*columns)).unionByName(alone.select(*columns))


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per distinct sequence
    of first turns (role, text), from the root of depth 0.

    ``conv_id`` is the smallest member and names, with the depth, the node.  ``n_leaves``
    and ``saved_tokens`` are of the subtree, the node included; a node saves the code
    points of its last text for each member but one.  ``ends_sha256`` is the digest of the
    decimal ids of the members that have no further turn, ascending, joined by commas.

    Turns are taken by ``turn``, null first, those of equal number by the digest of role
    and text; repeated rows are turns of their own.  Null and empty roles and texts are
    the same.  Rows without a conversation id belong to none and take no part.  Other
    columns are left out.  An empty table gives no rows.

    The sketch has ``MOST_CELLS`` cells a row at most.  With many more prefixes than cells
    it proves less and more is grouped; the result is the same.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    rows = scratch.save(facts(turns, conv_col, turn_col, role_col, text_col), "facts")
    return trie(rows, rows.select("conv").distinct(), scratch)


def shares(conv: Column, most: int) -> Column:
    """How many first turns a conversation takes from the first of its hundred: crc32 of its decimal id, below ``most``."""
    return F.crc32(conv.cast("string").cast("binary")) % most


def forked_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", most: int = 6) -> DataFrame:
    """``prefix_trie`` of conversations that begin like the first one of their hundred.

    Conversation ``c`` has the first ``shares(c, most)`` turns of conversation
    ``c - c % 100`` (all if fewer, none if that is not there), then its own turns after as
    many; one without any turn left is a member of the root.  Everything else is as there.
    """
    scratch = Scratch(turns.sparkSession, "forks")
    own = sequenced(facts(turns, conv_col, turn_col, role_col, text_col), scratch).select("conv", "pos", "key", "size")
    convs = scratch.save(own.where("pos = 1").select("conv"), "convs")
    h = shares(F.col("conv"), most)
    heads = own.where((F.col("conv") % 100 == 0) & (F.col("pos") < most)).groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "key", "size"))).alias("head"))
    begun = convs.withColumn("base", F.col("conv") - F.col("conv") % 100).join(heads, "base")
    begun = begun.select("conv", F.explode(F.slice("head", F.lit(1), h.cast("int"))).alias("t")).select("conv", F.col("t.pos").alias("turn"), "t.key", "t.size")
    rest = own.where(F.col("pos") > h).select("conv", F.col("pos").alias("turn"), "key", "size")
    return trie(begun.unionByName(rest), convs, scratch)


def sql() -> str:
    """The same rows from the prefixes as texts."""
    return """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), c AS (
  SELECT conv_id, CAST(xor(list_reduce(flatten([[4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: [ord(d), -1, -1, -1, -1, -1, -1, -1, -1]))]),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 6 AS BIGINT) AS h
  FROM (SELECT DISTINCT conv_id FROM conversations)
), r AS (
  SELECT c.conv_id, 0 AS own, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
), q AS (
  SELECT conv_id, row_number() OVER w AS depth, count(*) OVER (PARTITION BY conv_id) AS total, length(text) AS size,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS prefix
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos ROWS UNBOUNDED PRECEDING)
), m AS (
  SELECT conv_id, depth, size, prefix, depth = total AS last FROM q
  UNION ALL SELECT c.conv_id, 0, 0, '', NOT EXISTS (SELECT 1 FROM r WHERE r.conv_id = c.conv_id) FROM c
), n AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM m GROUP BY prefix, depth
), k AS (
  SELECT v.conv_id, v.depth, any_value(v.n_convs) AS n_convs, any_value(v.ends_sha256) AS ends_sha256, sum(u.saved) AS saved,
         count(*) FILTER (u.depth = v.depth + 1) AS n_children,
         count(*) FILTER (NOT EXISTS (SELECT 1 FROM n x WHERE x.depth = u.depth + 1 AND starts_with(x.prefix, u.prefix))) AS n_leaves, any_value(v.prefix) AS prefix
  FROM n v JOIN n u ON u.depth >= v.depth AND starts_with(u.prefix, v.prefix) GROUP BY v.conv_id, v.depth
)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, k.n_leaves, CAST(k.saved AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k LEFT JOIN n p ON p.depth = k.depth - 1 AND starts_with(k.prefix, p.prefix)
"""
