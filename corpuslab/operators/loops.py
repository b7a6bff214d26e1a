"""Maximal runs of a repeated phrase, in time that grows with the words and not with their square.

Inside a run whose shortest phrase has ``k`` words, a stretch of ``L >= k`` words was last
seen exactly ``k`` words before.  So for ``L`` = 1, 2, 4, ... every stretch of ``L`` words
is numbered by its content, and where the distance to the stretch's last place stays at
one ``k`` with ``L/2 < k <= L`` there is a run of period ``k``, and ``k`` is its shortest.
A run of five phrases is always longer than that takes, wherever it lies.

Transcripts are cut into blocks that see ``L`` words beyond their ends.  Stretches that
are open at a border are joined afterwards, so a run may go on over any number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize
from .running import running

#: Longest phrase of the first level, how much longer that of each next one is (both powers of two), and words of a block for each word of the phrase.
PHRASE, NEXT, BLOCK = 1024, 16, 16
#: Words that are looked at together.
CHUNK = 1 << 18
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _stretches(x: np.ndarray, longest: int, r: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(L, shortest period less one, content number of each stretch of L words).

    For two repetitions a run may be as short as ``2 k``, so every ``k`` has a length of its own.
    """
    size, h = 1, x
    yield 1, 0, h
    while size < longest and len(h) > size:
        if r == 2:
            h, low, size = _mixed(h[:-1] * FACTOR + x[size:]), size, size + 1
        else:
            h, low, size = _mixed(h[:-size] * FACTOR + h[size:]), size, 2 * size
        yield size, low, h


def found_in(x: np.ndarray, core: np.ndarray, longest: int, r: int, above: int = 0) -> np.ndarray:
    """(stretch from, to, L, k) of all stretches in ``core`` that are long enough for ``r`` repetitions or end where the core does.

    ``x`` holds the words of several rows with a number of its own between any two; ``core``
    marks the words whose stretches are asked for, ``above`` the longest phrase that is not.
    """
    out = []
    for size, low, h in _stretches(x, longest, r):
        if size <= above:
            continue
        order = np.argsort(h, kind="stable")
        again = h[order[1:]] == h[order[:-1]]
        distance = np.zeros(len(h) + 1, np.int64)
        distance[order[1:][again]] = (order[1:] - order[:-1])[again]
        distance[:-1][~core[: len(h)] | (distance[:-1] <= low) | (distance[:-1] > size)] = 0
        cut = np.flatnonzero(np.diff(distance, prepend=0))
        start, stop = cut[:-1], cut[1:]
        k = distance[start]
        start, stop, k = start[k > 0], stop[k > 0], k[k > 0]
        edge = ~core[np.maximum(start - 1, 0)] | (start == 0) | ~core[np.minimum(stop, len(core) - 1)] | (stop == len(core))
        keep = np.flatnonzero(edge | (stop - start >= (r - 1) * k - size + 1))
        # the numbers stand for the words; the words decide
        keep = [i for i in keep if np.array_equal(x[start[i] : stop[i] + size - 1], x[start[i] - k[i] : stop[i] + size - 1 - k[i]])]
        out.append(np.stack([start[keep], stop[keep], np.full(len(keep), size), k[keep]], 1))
    return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


def _joined(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All words with a number of its own behind each row, and where the rows begin."""
    starts = np.cumsum([0, *(len(w) + 1 for w in rows)])
    x = np.empty(starts[-1], np.uint64)
    for i, w in enumerate(rows):
        x[starts[i] : starts[i + 1] - 1] = w
        x[starts[i + 1] - 1] = i
    return x, starts


def _chunks(lists: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, words of the rows) of about ``CHUNK`` words."""
    rows: list[np.ndarray] = []
    first = size = 0
    for i in range(len(lists)):
        values = lists[i].values
        rows.append(np.zeros(0, np.uint64) if values is None else values.to_numpy(zero_copy_only=False).view(np.uint64))
        size += len(rows[-1])
        if size >= CHUNK:
            yield first, rows
            rows, first, size = [], i + 1, 0
    if rows:
        yield first, rows


def runs_in_rows(df: DataFrame, words: str, min_repetitions: int) -> DataFrame:
    """All columns of ``df`` with ``start, k, repetitions, run_end, reach`` of each maximal run in the row's words."""
    r = int(min_repetitions)
    if r < 2:
        raise ValueError("min_repetitions must be at least 2")
    names = df.columns
    added = ["start", "k", "repetitions", "run_end", "reach"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in _chunks(batch.column(len(names))):
                x, starts = _joined(rows)
                core = np.ones(len(x), bool)
                core[starts[1:] - 1] = False
                start, stop, size, k = found_in(x, core, max(map(len, rows)) // r, r).T
                reach = stop - 1 + size
                repetitions = (reach - start) // k + 1
                ok = repetitions >= r
                start, k, repetitions, reach = start[ok] - k[ok], k[ok], repetitions[ok], reach[ok]
                row = np.searchsorted(starts, start, side="right") - 1
                cols = start - starts[row], k, repetitions, start - starts[row] + k * repetitions, reach - starts[row]
                taken = batch.take(pa.array(first + row))
                yield pa.RecordBatch.from_arrays([*taken.columns[: len(names)], *map(pa.array, cols)], [*names, *added])

    rows = df.select(*names, F.transform(words, lambda w: F.xxhash64(w)).alias("__numbers"))
    return rows.mapInArrow(run, StructType([*df.schema.fields, *(StructField(n, LongType()) for n in added)]))


def _blocks(cues: DataFrame, key: str, order: str, words: str, phrase: int) -> DataFrame:
    """(key, at, core_from, core_to, numbers): word numbers of every block and of ``phrase`` words on either side, from word ``at`` on."""
    size = phrase * BLOCK
    first = F.greatest(F.lit(0), F.floor((F.col("word_start") - phrase) / size)).cast("long")
    last = F.floor((F.col("word_end") - 1 + phrase) / size).cast("long")
    spread = cues.where("word_end > word_start").withColumn("__b", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("__b") * size - phrase, F.col("word_start"))
    hi = F.least((F.col("__b") + 1) * size + phrase, F.col("word_end"))
    numbers = F.transform(F.slice(words, (lo - F.col("word_start") + 1).cast("int"), (hi - lo).cast("int")), lambda w: F.xxhash64(w))
    pieces = spread.where(hi > lo).select(key, "__b", lo.alias("__at"), numbers.alias("__p"))
    # a block has a fixed number of words, whatever the transcript
    whole = pieces.groupBy(key, "__b").agg(F.array_sort(F.collect_list(F.struct("__at", "__p"))).alias("__l"))
    at = F.col("__l")[0]["__at"]
    return whole.select(
        key, at.alias("at"), (F.col("__b") * size).alias("core_from"), ((F.col("__b") + 1) * size).alias("core_to"), F.flatten(F.transform("__l", lambda s: s["__p"])).alias("numbers")
    )


def _pieces(blocks: DataFrame, key: str, phrase: int, above: int, r: int) -> DataFrame:
    """(key, L, k, s, e, open): stretches of the blocks, ``open`` where one may go on in the next block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, core_from, core_to = (batch.column(j).to_numpy(zero_copy_only=False) for j in (1, 2, 3))
            for first, rows in _chunks(batch.column(4)):
                x, starts = _joined(rows)
                core = np.zeros(len(x), bool)
                for i, w in enumerate(rows):
                    own = slice(max(0, core_from[first + i] - at[first + i]), min(len(w), core_to[first + i] - at[first + i]))
                    core[starts[i] + own.start : starts[i] + max(own.start, own.stop)] = True
                start, stop, size, k = found_in(x, core, phrase, r, above).T
                row = np.searchsorted(starts, start, side="right") - 1
                s, e = start - starts[row] + at[first + row], stop - starts[row] + at[first + row]
                border = (s == core_from[first + row]) | (e == core_to[first + row])
                cols = [batch.column(0).take(pa.array(first + row)), *map(pa.array, (size, k, s, e, border))]
                yield pa.RecordBatch.from_arrays(cols, [key, "L", "k", "s", "e", "open"])

    kind = blocks.schema[key].dataType.simpleString()
    return blocks.mapInArrow(run, f"`{key}` {kind}, L long, k long, s long, e long, open boolean")


def transcript_runs(cues: DataFrame, key: str, order: str, words: str, min_repetitions: int = 5) -> DataFrame:
    """(key, start, k, repetitions, run_end, reach) of all maximal runs in whole transcripts, positions in words.

    Cues need ``word_start`` and ``word_end`` and their words; phrases may be of any length
    and a run may go over any number of cues.  Long phrases are looked for in larger
    blocks, of ``BLOCK + 2`` times their words, and only in transcripts that can hold five
    of them.  Cues without words and rows of a null key are passed over.
    """
    r = int(min_repetitions)
    if r < 3:
        raise ValueError("whole transcripts need at least 3 repetitions")
    known = cues.where(F.col(key).isNotNull()).select(key, "word_start", "word_end", words)
    lengths = known.groupBy(key).agg(F.max("word_end").alias("__n"))
    longest = lengths.agg(F.max("__n")).first()[0] or 0
    found, above, phrase = [], 0, PHRASE
    while True:
        rows = known if not above else known.join(lengths.where(F.col("__n") >= r * (above + 1)).select(key), key, "left_semi")
        found.append(_pieces(_blocks(rows, key, order, words, phrase), key, phrase, above, r))
        if longest < r * (phrase + 1):
            break
        above, phrase = phrase, phrase * NEXT
    pieces = found[0]
    for more in found[1:]:
        pieces = pieces.unionByName(more)
    pieces = materialize(pieces, "stretches")
    names = [key, "L", "k"]
    before = running(pieces.where("open"), names, "s", F.col("e"), "__before", how="last", inclusive=False)
    begun = materialize(before.withColumn("__new", F.when(F.col("__before").isNull() | (F.col("__before") != F.col("s")), F.col("s"))).select(*names, "s", "e", "__new"), "open-stretches")
    islands = running(begun, names, "s", F.col("__new"), "__first", how="last")
    joined = islands.groupBy(*names, "__first").agg(F.max("e").alias("e")).withColumnRenamed("__first", "s")
    whole = pieces.where("NOT open").select(*names, "s", "e").unionByName(joined.select(*names, "s", "e"))
    start, reach = F.col("s") - F.col("k"), F.col("e") - 1 + F.col("L")
    runs = whole.select(key, start.alias("start"), "k", (F.floor((reach - F.col("s")) / F.col("k")) + 1).cast("long").alias("repetitions"), reach.alias("reach"))
    return runs.where(F.col("repetitions") >= r).withColumn("run_end", F.col("start") + F.col("k") * F.col("repetitions"))
