"""Hard negatives of anchors: shared lists of candidates, walked until nothing better can follow.

Anchors are clustered by direction.  In every block of candidates a cluster sorts the
candidates once by an upper bound of their score: a candidate at angle ``t`` from the
cluster's centre is at angle ``t - w`` at least from a member, ``w`` being the widest
angle of a member.  Every member walks that list and stops once what it still lacks is
certain to lie behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.topn import top_per_group
from ..session import Scratch
from .common import first_by_hash

POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score between which a negative's score lies.
LOW, HIGH = 30, 90
SCALE = 256
#: Candidates of a block, anchors for which clusters are fitted, clusters, and members that walk a list together.
BLOCK, SAMPLE, CLUSTERS, MEMBERS = 1 << 15, 4096, 64, 256
ROUNDS = 8
#: Components of a block at most, so long vectors come in smaller blocks.
CELLS = 1 << 22
#: Candidates that are looked at together, at first and at most.
STEP_FIRST, STEP_MOST = 256, 4096
#: Relative error of the bounds.
SLACK = 1e-9


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(row, id, label, x): whole numbers ``floor(SCALE * component)``, without the rows that take no part."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.transform(v, lambda x: F.floor(SCALE * x))
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & fit)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("x"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of int64, shorter vectors filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dim), np.int64)
    at = np.repeat(np.arange(len(sizes)), sizes)
    start = np.cumsum(sizes) - sizes
    out[at, np.arange(len(at)) - start[at]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; zero vectors have direction zero."""
    x = x.astype(float)
    norm = np.linalg.norm(x, axis=1)
    return x / np.maximum(norm, 1e-300)[:, None], norm


def centres(x: np.ndarray, k: int) -> np.ndarray:
    """Directions of at most ``k`` clusters of the rows of ``x``."""
    d, norm = unit(x)
    d = np.unique(d[norm > 0], axis=0)
    if not len(d):
        return np.zeros((1, x.shape[1]))
    c = d[np.linspace(0, len(d) - 1, min(k, len(d))).astype(int)]
    for _ in range(ROUNDS):
        at = (d @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, d)
        new, size = unit(sums)
        c = np.where(size[:, None] > 0, new, c)
    return c


def exact(members: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products as int64; by floating point where that is exact."""
    most = float(np.abs(members).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, members.shape[1])
    if most < 2.0**53:
        return (members.astype(float) @ candidates.astype(float).T).astype(np.int64)
    if most < 2.0**63:
        return members @ candidates.T
    raise ValueError("inner products of these vectors may not fit into 64 bits")


class Wanted:
    """The best ``keep`` candidates of every slot (member, goal), whose scores lie from ``low`` to ``high``."""

    def __init__(self, low: np.ndarray, high: np.ndarray, keep: int):
        self.low, self.high, self.keep = low, high, keep
        self.slot = self.score = self.id = self.row = np.zeros(0, np.int64)
        # what a further candidate has to beat: a score, and on a tie an id
        self.least, self.tie = low.copy(), np.full(len(low), np.iinfo(np.int64).max)

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(slot):
            return
        cols = [np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids), (self.row, rows))]
        order = np.lexsort((cols[3], cols[2], -cols[1], cols[0]))
        cols = [c[order] for c in cols]
        first = np.searchsorted(cols[0], cols[0])
        rank = np.arange(len(order)) - first
        kept = rank < self.keep
        self.slot, self.score, self.id, self.row = (c[kept] for c in cols)
        full = np.flatnonzero(rank == self.keep - 1)
        self.least[cols[0][full]], self.tie[cols[0][full]] = cols[1][full], cols[2][full]

    def open(self, bound: np.ndarray) -> np.ndarray:
        """Slots that a candidate of this bound may still enter."""
        return (bound >= self.least) & (self.low <= self.high)


def walk(block: dict, members: dict, centre: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int, same: bool) -> Wanted:
    """The best candidates of ``block`` for each slot of the members; ``low``, ``high``: (members, goals).

    ``same``: candidates of the member's own label, the member itself left out, else those of other labels.
    """
    goals = low.shape[1]
    wanted = Wanted(low.ravel().copy(), high.ravel().copy(), keep)
    direction, norm = unit(members["x"])
    angle = np.arccos(np.clip(direction[norm > 0] @ centre, -1, 1))
    wide = angle.max(initial=0.0)
    theta = np.arccos(np.clip(block["direction"] @ centre, -1, 1))
    bound = block["norm"] * (np.cos(np.maximum(theta - wide, 0.0)) + SLACK)
    order = np.argsort(-bound, kind="stable")
    at, step = 0, STEP_FIRST
    walking = np.arange(len(norm))
    while at < len(order) and len(walking):
        reach = np.repeat(norm * bound[order[at]] + SLACK * (1 + norm * abs(bound[order[at]])), goals)
        still = wanted.open(reach).reshape(-1, goals).any(1)
        walking = walking[still[walking]]
        if not len(walking):
            break
        part = order[at : at + step]
        score = exact(members["x"][walking], block["x"][part])
        fit = (members["label"][walking][:, None] == block["label"][part][None, :]) == same
        if same:
            fit &= members["row"][walking][:, None] != block["row"][part][None, :]
        ids = block["id"][part]
        for g in range(goals):
            slot = walking * goals + g
            least = wanted.least[slot][:, None]
            better = fit & (score <= wanted.high[slot][:, None]) & ((score > least) | ((score == least) & (ids[None, :] < wanted.tie[slot][:, None])))
            i, j = np.nonzero(better)
            wanted.offer(slot[i], score[i, j], ids[j], block["row"][part][j])
        at += len(part)
        step = min(2 * step, STEP_MOST)
    return wanted


def searched(candidates: DataFrame, anchors: DataFrame, blocks: int, dim: int, found: np.ndarray, keep: int, same: bool) -> DataFrame:
    """(anchor, goal, score, id, row): for each anchor and goal the best candidates of every block.

    ``candidates``: row, id, label, x, block.  ``anchors``: row, label, x, cluster, lows, highs.  Anchors are sent to all blocks,
    candidates move once; a task holds one block and walks the clusters one after the other.
    """
    none = F.lit(None)
    left = candidates.select("block", F.lit(-1).alias("cluster"), "row", "id", "label", "x", none.cast("array<long>").alias("lows"), none.cast("array<long>").alias("highs"))
    right = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "cluster", "row", F.lit(0).cast("long").alias("id"), "label", "x", "lows", "highs")
    rows = left.unionByName(right).repartition(blocks, "block").sortWithinPartitions("block", "cluster", "row")
    sent = candidates.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict = {}
        waiting: list[pa.RecordBatch] = []

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal block
            if not waiting:
                return
            t = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            cluster = t["cluster"][0].as_py()
            one = {c: t[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("row", "id", "label")}
            one["x"] = matrix(t["x"].combine_chunks(), dim)
            if cluster < 0:
                one["direction"], one["norm"] = unit(one["x"])
                block = {"place": t["block"][0].as_py(), **one}
                return
            if block.get("place") != t["block"][0].as_py():
                return
            low, high = (np.array(t[c].to_pylist(), np.int64).reshape(len(one["row"]), -1) for c in ("lows", "highs"))
            w = walk(block, one, sent.value[cluster], low, high, keep, same)
            goals = low.shape[1]
            cols = one["row"][w.slot // goals], w.slot % goals, w.score, w.id, w.row
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["anchor", "goal", "score", "id", "row"])

        now = None
        for batch in batches:
            keys = [batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)]
            change = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                if a == b:
                    continue
                key = int(keys[0][a]), int(keys[1][a])
                # candidates of a block are taken together, members of a cluster so many at a time
                if key != now or (key[1] >= 0 and sum(x.num_rows for x in waiting) >= MEMBERS):
                    yield from out()
                    now = key
                waiting.append(batch.slice(a, b - a))
        yield from out()

    return rows.mapInArrow(run, "anchor long, goal long, score long, id long, row long")


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame | None = None, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK, sample: int = SAMPLE, clusters: int = CLUSTERS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``, or those whose id is in the
    first column of ``anchors``.  Scores are inner products of ``floor(256 * component)``,
    higher first, ties by smaller id.  For each anchor and each of its first ``positives``
    other rows of the same label: its first ``negatives`` rows of other labels with
    ``low * positive <= 100 * score <= high * positive``.

    Rows with a null id or label, a null vector or a null or non-finite component take no
    part.  A shorter vector counts as filled up with zeros, an empty one as zero.
    Repeated rows are rows of their own, so a copy of an anchor is one of its positives,
    and anchors of equal id each give their rows.  Anchors without positives, and positives
    without negatives (all of score below zero, since their bounds cross), give no rows.
    Scores that may not fit into 64 bits are an error.  Other columns are left out.  An empty table gives no rows.

    Clusters are fitted to at most ``sample`` anchors; all anchors are searched against all
    rows, ``block`` rows at a time (fewer if the vectors are long), whatever the clusters.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    rows = scratch.save(prepared(vectors, id_col, vector_col, label_col), "rows")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("x")), F.lit(0)).alias("dim")).first()
    dim = max(1, size["dim"])
    blocks = max(1, -(-size["n"] // max(1, min(block, CELLS // dim))))
    # dealt by hash of the row, so neither a label nor copies of a vector fill a block
    candidates = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    chosen = rows.where(F.col("id") % every == 0) if anchors is None else rows.join(anchors.select(F.col(anchors.columns[0]).cast("long").alias("id")).distinct(), "id", "left_semi")
    few = first_by_hash(chosen.select("row", "x"), "row", sample).select("x").toArrow()["x"].combine_chunks()
    found = centres(matrix(few, dim), clusters)
    sent = spark.sparkContext.broadcast(found)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = (unit(matrix(batch.column(3), dim))[0] @ sent.value.T).argmax(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], ["row", "id", "label", "x", "cluster"])

    members = scratch.save(chosen.select("row", "id", "label", "x").mapInArrow(assign, "row long, id long, label long, x array<long>, cluster int"), "anchors")
    any_score = [F.array(F.lit(x).cast("long")) for x in (-(1 << 63), (1 << 63) - 1)]
    goals = members.withColumns({"lows": any_score[0], "highs": any_score[1]})
    order = [F.desc("score"), F.asc("id"), F.asc("row")]
    best = top_per_group(searched(candidates, goals, blocks, dim, found, positives, True), ["anchor"], order, positives, rank="place")
    # at most ``positives`` to an anchor
    best = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("best"))
    best = scratch.save(members.join(best, members["row"] == best["anchor"]).drop("anchor"), "positives")

    # a goal that is not there, or that nothing can meet, has its bounds crossed
    score = lambda i: F.get("best", i)["score"]
    places = F.sequence(F.lit(0), F.lit(positives - 1))
    lows = F.transform(places, lambda i: F.coalesce(F.ceil(score(i).cast("decimal(20,0)") * low / 100).cast("long"), F.lit(1).cast("long")))
    highs = F.transform(places, lambda i: F.coalesce(F.floor(score(i).cast("decimal(20,0)") * high / 100).cast("long"), F.lit(0).cast("long")))
    goals = best.select("row", "label", "x", "cluster", lows.alias("lows"), highs.alias("highs"))
    worst = top_per_group(searched(candidates, goals, blocks, dim, found, negatives, False), ["anchor", "goal"], order, negatives, rank="rank")
    named = best.select("row", F.col("id").alias("anchor_id"), "best")
    out = worst.select("anchor", "goal", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(named, F.col("anchor") == F.col("row"))
    positive = F.get("best", F.col("goal").cast("int"))
    return out.select("anchor_id", positive["id"].alias("positive_id"), "rank", "negative_id", positive["score"].alias("positive_score"), "negative_score")


def sql() -> str:
    """The same rows from the scores of all anchors with all rows."""
    return """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e WHERE vec_id % 100 = 0) a
  JOIN (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e) b ON a.i = b.i AND a.vec_id <> b.vec_id
  GROUP BY ALL
), p AS (
  SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5
), r AS (
  SELECT p.a AS anchor_id, p.b AS positive_id, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10
"""
