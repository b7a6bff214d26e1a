"""Class-based n-gram scores: exchange clustering, class transitions and word emissions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import fold, id_and_text

#: Most frequent words, which exchange clustering deals out to ``CLASSES`` first.  All others start in the class of their length
#: and then move, ``MOVES`` times half of them, to the class that fits the words around them.
CLUSTERED = 1024
MOVES = 3
CLASSES = 48
LENGTHS = 12
ROUNDS = 8
#: Most frequent words that every task holds as such.
HELD = 131_072
#: Pairs or contexts that a task takes together before it hands them on, and tokens that it reads together.
FLUSH_PAIRS, READ_TOKENS = 1 << 20, 1 << 17
#: Words that a task counts together before it hands them on, and bytes of text that it takes apart together.
FLUSH_WORDS, READ_BYTES = 1 << 22, 1 << 22
END = ""
ALPHA = 0.1
#: Most frequent words beside the held ones whose hashes, classes and counts a task holds (36 MB); those of all others come by joins.
KNOWN = 1 << 21
#: Words of training texts that occur once are held only if they are no more than this: a table in every task spares them one
#: join each, which grows with the texts as they do.
ONCE = 1 << 18
#: Occurrences of a word that one row takes up, and rows for the words that keep the class of their length.
ROW_WORDS, UNKNOWN_PARTS = 1 << 20, 256
#: Rows in which a task hands on the neighbours that it counted together; each has the words of one remainder.
BUCKETS = 1 << 12
#: What a move has to gain, as a share of the cost of naming one class of all.
PRICE = 1.0
#: Counts up to which gains are looked up.
FEW = 32


def length_class(sizes: np.ndarray) -> np.ndarray:
    return np.minimum((sizes - 1) // 2, LENGTHS - 1)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``READ_BYTES`` bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // READ_BYTES, append=-1)) + 1
    for start, stop in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
        yield batch.slice(start, stop - start)


def ended_words(texts: pa.Array) -> pa.ListArray:
    """Words of each text as ``common.words_of`` has them, then the empty word, its end; null counts as empty."""
    bare = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # what is split off behind a blank is the end; a text without words is its end
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(pc.binary_length(bare), 0), "", pc.binary_join_element_wise(bare, "", " ")))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; the empty word stands for the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.Array] = []

        def out() -> pa.RecordBatch:
            seen = pa.chunked_array(pending).value_counts()
            pending.clear()
            return pa.RecordBatch.from_arrays([seen.field("values"), seen.field("counts")], ["word", "n"])

        for batch in batches:
            for part in slices(batch):
                pending.append(ended_words(part.column("text")).flatten())
                if sum(map(len, pending)) >= FLUSH_WORDS:
                    yield out()
        if pending:
            yield out()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> list:
    """The most frequent words, at most ``most``, by count and word.

    A histogram of the counts in eighths of a power of two gives the smallest count that
    is taken, so the driver gets no more rows than that.
    """
    bin_of = F.floor(F.log2("n") * 8)
    taken, lowest = 0, None
    for r in sorted(counts.groupBy(bin_of.alias("b")).count().collect(), reverse=True):
        taken += r["count"]
        if taken > most:
            break
        lowest = r["b"]
    return [] if lowest is None else sorted(counts.where(bin_of >= lowest).collect(), key=lambda r: (-r["n"], r["word"]))


class Symbols:
    """Class symbols of words: the clustered words, the length classes, the end."""

    def __init__(self, held: list[str], clustered: int):
        self.place = pa.array(held, pa.string())
        self.clustered = min(clustered, len(held))
        self.size = self.clustered + LENGTHS + 1
        self.end = self.size - 1
        # by place, then that of the end
        self.held_symbols = np.append(np.arange(len(held)), self.end)
        self.held_symbols[self.clustered : -1] = self.clustered + length_class(sizes_of(self.place[self.clustered :]))

    def of(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.DictionaryArray]:
        """(place in the held words or -1, symbol, text index, words) of all words, each text followed by its end (place -2)."""
        lists = ended_words(pa.array(texts, pa.string()))
        flat = lists.flatten().dictionary_encode()
        place, symbol = self.of_words(flat.dictionary)
        at = flat.indices.to_numpy()
        return place[at], symbol[at], np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), flat

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place, symbol) of words as ``of`` has them."""
        place = pc.fill_null(pc.index_in(words, value_set=self.place), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        length = sizes_of(words)
        symbol = np.where((place >= 0) & (place < self.clustered), place, self.clustered + length_class(length))
        ends = length == 0
        symbol[ends], place[ends] = self.end, -2
        return place, symbol

    @staticmethod
    def before(symbol: np.ndarray, end: int) -> np.ndarray:
        """Symbol before each; texts begin after an end."""
        return np.concatenate([[end], symbol[:-1]])

    def keys(self, place: np.ndarray, flat: pa.DictionaryArray) -> np.ndarray:
        """Place of held words, their number for the end, a negative hash of 63 bits for all others."""
        out = place.copy()
        out[place == -2] = len(self.place)
        loose = place == -1
        out[loose] = loose_keys(flat, loose)
        return out


def sizes_of(words: pa.Array) -> np.ndarray:
    """Bytes of each word."""
    return pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)


def rest_keys(words: list[bytes]) -> np.ndarray:
    return (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) | np.uint64(1 << 63)).view(np.int64)


def loose_keys(flat: pa.DictionaryArray, loose: np.ndarray) -> np.ndarray:
    """``rest_keys`` of the words of ``flat`` that ``loose`` marks; every distinct word is hashed once."""
    at = flat.indices.to_numpy()[loose]
    used = np.zeros(len(flat.dictionary), bool)
    used[at] = True
    keys = np.zeros(len(used), np.int64)
    words = flat.dictionary.filter(pa.array(used))
    if len(words):
        # cut out of the buffer at once: a list made by Arrow has a scalar a word
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].tolist()
        data = words.buffers()[2].to_pybytes()
        keys[used] = rest_keys([data[i:j] for i, j in zip(ends, ends[1:])])
    return keys[at]


def blobs(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    """A binary column of the values from each of ``starts``, which end with their number: columns of arrays would pass the JVM value by value."""
    values = np.ascontiguousarray(values)
    offsets = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(values, number of values per row) of a column of ``blobs``."""
    size = np.dtype(kind).itemsize
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    count = int(offsets[-1] - offsets[0]) // size
    return np.frombuffer(column.buffers()[2], kind, count, offsets[0]) if count else np.zeros(0, kind), np.diff(offsets) // size


def encoded(docs: DataFrame, held) -> DataFrame:
    """``docs`` with ``key`` (see ``Symbols.keys``) of all words and ends, -1 for those that are not held, and for these
    ``rest``, the key, and ``size``, the length class, in place of the text."""
    keep = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(*held.value)
        for batch in batches:
            for part in slices(batch):
                place, symbol, text, flat = symbols.of(part.column("text"))
                place[place == -2] = len(symbols.place)
                loose = place == -1
                ends = [np.concatenate([[0], np.cumsum(np.bincount(of, minlength=part.num_rows))]) for of in (text, text[loose])]
                cols = blobs(ends[0], place.astype(np.int32)), blobs(ends[1], loose_keys(flat, loose)), blobs(ends[1], (symbol[loose] - symbols.clustered).astype(np.int8))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *cols], [*keep, "key", "rest", "size"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in keep)
    return docs.mapInArrow(run, schema + "key binary, rest binary, size binary")


def tokens(batch: pa.RecordBatch, symbols: "Symbols") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch of ``encoded`` of about ``READ_TOKENS`` tokens: (rows, key, symbol, text index)."""
    at = batch.schema.get_field_index("key")
    total = np.cumsum(unpacked(batch.column(at), np.int32)[1])
    cuts = np.flatnonzero(np.diff(total // READ_TOKENS, append=-1)) + 1
    for start, stop in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
        part = batch.slice(start, stop - start)
        place, sizes = unpacked(part.column(at), np.int32)
        key = place.astype(np.int64)
        symbol = symbols.held_symbols[np.maximum(key, 0)]
        loose = key < 0
        key[loose] = unpacked(part.column(at + 1), np.int64)[0]
        symbol[loose] = symbols.clustered + unpacked(part.column(at + 2), np.int8)[0].astype(np.int64)
        yield part, key, symbol, np.repeat(np.arange(stop - start), sizes)


def of_tokens(docs: DataFrame, held) -> DataFrame:
    return docs.select("key", "rest", "size") if "key" in docs.columns else encoded(docs.select("text"), held)


def bigram_counts(docs: DataFrame, held) -> DataFrame:
    """(pair, n): counts of neighbouring symbols, at most the square of their number; ``docs`` has texts or is ``encoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(*held.value)
        total = np.zeros(symbols.size**2, np.int64)
        for batch in batches:
            for _, _, symbol, _ in tokens(batch, symbols):
                total += np.bincount(symbols.before(symbol, symbols.end) * symbols.size + symbol, minlength=len(total))
        pair = np.flatnonzero(total)
        for i in range(0, len(pair), 100_000):
            part = pair[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["pair", "n"])

    return of_tokens(docs, held).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def joint(keys: list[np.ndarray]) -> np.ndarray | None:
    """One number per row in the order of its keys, None if 63 bits are too few; one number is sorted faster than several."""
    out, size = np.zeros(len(keys[0]), np.int64), 1
    for k in keys if len(keys[0]) else ():
        low, span = int(k.min()), int(k.max()) - int(k.min()) + 1
        size *= span
        if size >= 1 << 63:
            return None
        out = out * span + (k - low)
    return out


def summed(keys: list[np.ndarray], n: np.ndarray) -> list[np.ndarray]:
    """The distinct rows of ``keys`` and the sums of ``n``."""
    order = np.lexsort(keys[::-1]) if (one := joint(keys)) is None else np.argsort(one)
    keys, n = [k[order] for k in keys], n[order]
    new = np.ones(len(n), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return [*(k[first] for k in keys), np.add.reduceat(n, first) if len(n) else n]


class Known(Symbols):
    """Numbers of words: held words by their place, the end behind them, then the ``known`` others in the order of their
    hash; words beyond have ``-1`` less the class of their length."""

    def __init__(self, held: list[str], clustered: int, known: np.ndarray, at: np.ndarray):
        super().__init__(held, clustered)
        self.known, self.at = known, at

    def numbers(self, place: np.ndarray, symbol: np.ndarray, flat: pa.DictionaryArray) -> np.ndarray:
        return self.numbered(self.keys(place, flat), symbol)

    def numbered(self, key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out = key.copy()
        rest = np.flatnonzero(key < 0)
        found = self.looked_up(key[rest])
        out[rest] = np.where(found >= 0, found, -1 - self.at[symbol[rest]])
        return out

    def loose(self, numbers: np.ndarray) -> np.ndarray:
        """Whether words are neither clustered nor the end."""
        end = len(self.place)
        return (numbers < 0) | (numbers > end) | ((numbers >= self.clustered) & (numbers < end))

    def looked_up(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of words that are not held by their keys, -1 of those that are not known."""
        if not len(self.known):
            return np.full(len(keys), -1)
        i = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return np.where(self.known[i] == keys, i + len(self.place) + 1, -1)


def neighbours(docs: DataFrame, held, known, at: np.ndarray, parts: np.ndarray, apart: bool = False) -> DataFrame:
    """(w, multi, o, n): per word that is not clustered its neighbours, twice their number and one more if they come after it.

    Made once: words are counted in the tasks, which hand on one row per bucket of words, and
    packed into one row a word.  ``parts``: into how many rows each held word is dealt
    (``multi``), so that a frequent word's neighbours are spread over tasks; so are those
    of the unknown words.  ``apart``: pairs with an unknown word are left to ``rare_rows``.
    """
    sent = docs.sparkSession.sparkContext.broadcast((at, parts))

    def sizes(n_known: int) -> tuple[int, int, int, int]:
        """(lowest, words, rows of a bucket, span): unknown words are above ``-1 - lowest``, ``words`` is odd so that the parts of a word are in different buckets."""
        at, parts = sent.value
        lowest = int(at.max(initial=0)) + 1
        words = (len(parts) + n_known + lowest) | 1
        most = max(UNKNOWN_PARTS, int(parts.max(initial=1)))
        return lowest, words, -(-words * most // BUCKETS), 2 * words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = sent.value
        words = Known(*held.value, known.value, at)
        end = len(words.place)
        lowest, n_words, rows, span = sizes(len(words.known))
        pending: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            b = np.concatenate(pending)
            pending.clear()
            # every group of texts ends with an end, which is also what stands before a text
            a = np.concatenate([[end], b[:-1]])
            loose = [words.loose(x) & ~(((a < 0) | (b < 0)) & apart) for x in (a, b)]
            w, o = np.concatenate([b[loose[1]], a[loose[0]]]), np.concatenate([a[loose[1]] * 2, b[loose[0]] * 2 + 1])
            many = np.where(w < 0, UNKNOWN_PARTS, parts[np.clip(w, 0, end)])
            many[w > end] = 1
            row = w + lowest
            dealt = np.flatnonzero(many > 1)
            row[dealt] += (o[dealt] * 0x9E3779B1 >> 7) % many[dealt] * n_words
            # a word and its part are a row, rows are in the order of their buckets; a row and a neighbour make one number
            pair = np.sort((row % BUCKETS * rows + row // BUCKETS) * span + o + 2 * lowest)
            first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: len(pair)])
            n = np.diff(first, append=len(pair))
            row, o = np.divmod(pair[first], span)
            starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)])
            row, inside = row[starts], np.diff(starts, append=len(o))
            bucket = row // rows
            new = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
            ends = np.append(new, len(row))
            pairs = blobs(np.append(starts, len(o))[ends] * 2, np.column_stack([o, n]).astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(bucket[new].astype(np.int32)), blobs(ends, row), blobs(ends, inside.astype(np.int32)), pairs], ["bucket", "row", "inside", "pairs"])

        for batch in batches:
            for _, key, symbol, _ in tokens(batch, words):
                pending.append(words.numbered(key, symbol))
                if sum(map(len, pending)) >= FLUSH_PAIRS:
                    yield out()
        if pending:
            yield out()

    rows = of_tokens(docs, held).mapInArrow(run, "bucket int, row binary, inside binary, pairs binary").repartition("bucket").sortWithinPartitions("bucket")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, end = sent.value[1], len(sent.value[1]) - 1
        lowest, n_words, rows, _ = sizes(len(known.value))
        pending: list[tuple[np.ndarray, ...]] = []

        def out(last: bool) -> Iterator[pa.RecordBatch]:
            row, inside, pairs = (np.concatenate(x) for x in zip(*pending))
            # the last bucket may go on
            cut = len(row) if last else int(np.searchsorted(row // rows, row[-1] // rows))
            taken = int(inside[:cut].sum())
            pending[:] = [] if last else [(row[cut:], inside[cut:], pairs[taken:])]
            if not cut:
                return
            of, o, n = summed([np.repeat(row[:cut], inside[:cut]), pairs[:taken, 0]], pairs[:taken, 1].astype(np.int64))
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            ends = np.append(starts, len(of))
            bucket, place = np.divmod(of[starts], rows)
            w = (place * BUCKETS + bucket) % n_words - lowest
            multi = (w < 0) | ((w <= end) & (parts[np.clip(w, 0, end)] > 1))
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.int32()), pa.array(multi), blobs(ends, (o - 2 * lowest).astype(np.int32)), blobs(ends, n)], ["w", "multi", "o", "n"])

        for batch in batches:
            # a slice has few buckets' rows, so that little is held beside a bucket that goes on
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                pending.append((unpacked(part.column(1), np.int64)[0], unpacked(part.column(2), np.int32)[0], unpacked(part.column(3), np.int32)[0].reshape(-1, 2)))
                if sum(len(x[2]) for x in pending) >= FLUSH_PAIRS and pending[0][0][0] // rows != pending[-1][0][-1] // rows:
                    yield from out(False)
        if pending:
            yield from out(True)

    return rows.mapInArrow(pack, "w int, multi boolean, o binary, n binary")


def rare_rows(docs: DataFrame, held, known, at: np.ndarray, rare: DataFrame) -> DataFrame:
    """(w, class, mixed, o, n): one row per word beyond the known ones, by its hash, with its neighbours and twice their number, one more if they come after it.

    What ``neighbours`` leaves out.  Neighbours are numbers or, beyond the known words, hashes;
    ``mixed``: whether there is such a hash among them.  ``rare`` is (w, class).  No key is
    frequent: the most frequent words are known.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Known(*held.value, known.value, at)
        end = len(words.place)
        for batch in batches:
            for _, key, _, _ in tokens(batch, words):
                b = key.copy()
                rest = np.flatnonzero(key < 0)
                found = words.looked_up(key[rest])
                b[rest] = np.where(found >= 0, found, key[rest])
                a = np.concatenate([[end], b[:-1]])
                w, o = np.concatenate([b[b < 0], a[a < 0]]), np.concatenate([a[b < 0], b[a < 0]])
                w, o, after, n = summed([w, o, np.repeat([0, 1], [(b < 0).sum(), (a < 0).sum()])], np.ones(len(w), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(o), pa.array(after == 1), pa.array(n)], ["w", "o", "after", "n"])

    rows = of_tokens(docs, held).mapInArrow(run, "w long, o long, after boolean, n long").repartition("w")
    rows = rows.groupBy("w", "o", "after").agg(F.sum("n").alias("n"))
    rows = rows.groupBy("w").agg(F.collect_list(F.struct("o", "after", "n")).alias("c"), (F.min("o") < 0).alias("mixed"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column(3)
            ends = np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False))])
            o, after, n = (c.flatten().field(j).to_numpy(zero_copy_only=False) for j in range(3))
            yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(3)), blobs(ends, o), blobs(ends, n * 2 + after)], ["w", "class", "mixed", "o", "n"])

    return rows.join(rare, "w").select("w", "class", "mixed", "c").mapInArrow(pack, "w long, class long, mixed boolean, o binary, n binary")


def rare_pairs(rows: DataFrame) -> DataFrame:
    """(w, o, after, n) of ``rare_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            o, sizes = unpacked(batch.column(1), np.int64)
            n = unpacked(batch.column(2), np.int64)[0]
            w = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(o), pa.array(n & 1 == 1), pa.array(n >> 1)], ["w", "o", "after", "n"])

    return rows.select("w", "o", "n").mapInArrow(run, "w long, o long, after boolean, n long")


def numbers_beside(rows: DataFrame) -> DataFrame:
    """(o): the distinct numbers among the neighbours of ``rare_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            o = np.unique(unpacked(batch.column(0), np.int64)[0])
            yield pa.RecordBatch.from_arrays([pa.array(o[o >= 0])], ["o"])

    return rows.select("o").mapInArrow(run, "o long").distinct()


def with_classes(pairs: DataFrame, rare: DataFrame) -> DataFrame:
    """(w, o, after, n) of mixed ``rare_rows`` with the classes ``cw`` of their words and ``co`` of neighbours beyond the known ones; ``rare`` is (w, class)."""
    pairs = pairs.join(rare.select("w", F.col("class").alias("cw")), "w")
    met = pairs.where("o < 0").join(rare.select(F.col("w").alias("o"), F.col("class").alias("co")), "o")
    return met.unionByName(pairs.where("o >= 0").withColumn("co", F.lit(None).cast("long"))).select("w", "o", "after", "n", "cw", "co")


def rare_codes(batch: pa.RecordBatch, classes: np.ndarray, n_classes: int) -> tuple[np.ndarray, ...]:
    """(w, own class, row, o, after, code, n) of a batch of ``with_classes`` or of ``rare_rows`` that are not mixed, the code as ``opened`` has it."""
    if batch.schema.names[1] == "class":
        w, own = (batch.column(j).to_numpy(zero_copy_only=False) for j in (0, 1))
        o, sizes = unpacked(batch.column(2), np.int64)
        n = unpacked(batch.column(3), np.int64)[0]
        row, after, n = np.repeat(np.arange(len(w)), sizes), n & 1, n >> 1
        other = classes[o]
    else:
        w, o, after, n, own = (batch.column(j).to_numpy(zero_copy_only=False) for j in range(5))
        row = np.arange(len(w))
        other = np.where(o < 0, batch.column(5).fill_null(0).to_numpy(zero_copy_only=False), classes[np.maximum(o, 0)])
    after = after.astype(np.int64)
    return w, own, row, o, after, other.astype(np.int64) + after * n_classes, n


def classes_of(numbers: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return np.where(numbers >= 0, classes[np.maximum(numbers, 0)], -1 - numbers).astype(np.int64)


def opened(batch: pa.RecordBatch, classes: np.ndarray, n_classes: int) -> tuple[np.ndarray, ...]:
    """(w, row, o, code, n) of a batch of ``neighbours``: code is the class of the one before, or ``n_classes`` more than that of the one after."""
    w = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    o, sizes = unpacked(batch.column(2), np.int32)
    row, n = np.repeat(np.arange(len(w)), sizes), unpacked(batch.column(3), np.int64)[0]
    return w, row, o >> 1, classes_of(o >> 1, classes) + (o & 1) * n_classes, n


def rest_and_held(counts: DataFrame, held, at: np.ndarray) -> DataFrame:
    """(w, n, class): key, count and first class, by length, of all words that are not clustered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(*held.value)
        for batch in batches:
            flat = batch.column(0).dictionary_encode()
            place, symbol = (x[flat.indices.to_numpy()] for x in symbols.of_words(flat.dictionary))
            cols = symbols.keys(place, flat), batch.column(1), at[symbols.clustered + length_class(sizes_of(batch.column(0)))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["w", "n", "class"]).filter(pa.array((place < 0) | (place >= symbols.clustered)))

    return counts.where(F.col("word") != END).select("word", "n").mapInArrow(run, "w long, n long, class long")


def class_matrix(near: DataFrame, classes, clustered: int, end: int, fixed: np.ndarray) -> np.ndarray:
    """Counts of (class before, class): ``fixed`` of the clustered words among themselves, and all others'."""
    n_classes = len(fixed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_classes**2, np.int64)
        for batch in batches:
            w, row, o, code, n = opened(batch, classes.value, n_classes)
            own = classes_of(w, classes.value)[row]
            before = code < n_classes
            # a pair of two loose words stands with both of them and counts with the second
            after = ~before & (((o >= 0) & (o < clustered)) | (o == end))
            pair = np.where(before, code * n_classes + own, own * n_classes + code - n_classes)
            use = before | after
            total += np.bincount(pair[use], n[use], n_classes**2).astype(np.int64)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], ["pair", "n"])

    m = fixed.astype(float).ravel().copy()
    for r in near.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        m[r["pair"]] += r["n"]
    return m.reshape(n_classes, n_classes)


def rare_matrix(rows: list[DataFrame], classes, n_classes: int) -> np.ndarray:
    """What the words beyond the known ones add to ``class_matrix``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_classes**2, np.int64)
        for batch in batches:
            _, own, row, o, after, code, n = rare_codes(batch, classes.value, n_classes)
            own = own[row]
            # a pair of two such words stands with both of them and counts with the second
            use = (after == 0) | (o >= 0)
            pair = np.where(after == 0, code * n_classes + own, own * n_classes + code - n_classes)
            total += np.bincount(pair[use], n[use], n_classes**2).astype(np.int64)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], ["pair", "n"])

    m = np.zeros(n_classes**2)
    for of in rows:
        for r in of.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
            m[r["pair"]] += r["n"]
    return m.reshape(n_classes, n_classes)


def xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def likelihood(m: np.ndarray) -> float:
    """What the classes decide of the log-likelihood of the texts."""
    return float(xlogx(m).sum() - xlogx(m.sum(0)).sum() - xlogx(m.sum(1)).sum())


def decided(w: np.ndarray, own: np.ndarray, row: np.ndarray, code: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Class of each word with the largest gain.

    The gain is that of ``exchange`` with all other words where they are; counts before and
    after the word are taken one by one.
    """
    n_classes = len(m)
    sides = (m.T, m)  # by class of the neighbour, then class of the word: after it, before it
    logs = [xlogx(side) for side in sides]
    sums = (m.sum(1), m.sum(0))
    gain = np.zeros((len(w), n_classes))
    few = np.arange(FEW, dtype=float)[:, None, None]
    for side in (0, 1):
        # of small counts, by count, class of the neighbour and class of the word
        small = xlogx(sides[side] + few) - logs[side]
        at = np.flatnonzero((code < n_classes) == bool(side))
        for i in range(0, len(at), 1 << 14):
            e = at[i : i + (1 << 14)]
            k, c, of = n[e].astype(float), code[e] % n_classes, row[e]
            more = small[np.minimum(n[e], FEW - 1), c]
            large = np.flatnonzero(n[e] >= FEW)
            if len(large):
                more[large] = xlogx(sides[side][c[large]] + k[large, None]) - logs[side][c[large]]
            # without the word itself in its class
            here = np.arange(len(e)), own[of]
            rest = np.maximum(sides[side][c, own[of]] - k, 0)
            more[here] = xlogx(rest + k) - xlogx(rest)
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            np.add.at(gain, of[first], np.add.reduceat(more, first, axis=0))
        size = np.bincount(row[at], n[at], len(w))
        rest = np.repeat(sums[side][None, :], len(w), 0)
        rest[np.arange(len(w)), own] -= size
        rest = np.maximum(rest, 0)
        gain -= xlogx(rest + size[:, None]) - xlogx(rest)
    gain = gain.round(7)  # the order of the sums decides no tie
    # nothing joins the class of the end; a word moves for more than it costs to name its class
    best = gain[:, : n_classes - 1].argmax(1)
    mine = gain[np.arange(len(w)), own]
    return np.where(gain[np.arange(len(w)), best] > mine + PRICE * np.log(n_classes) + 1e-6 * (1 + np.abs(mine)), best, own)


def moved_alone(rows: DataFrame, m: np.ndarray, classes, turn: int) -> DataFrame:
    """``rare_rows`` that are not mixed with their new classes: their neighbours' classes are in the task, so no row leaves it."""
    n_classes = len(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, own = (batch.column(j).to_numpy(zero_copy_only=False) for j in (0, 1))
            go = (w & 1) == turn % 2
            new = own.copy()
            w, own, row, _, _, code, n = rare_codes(batch.filter(pa.array(go)), classes.value, n_classes)
            new[go] = decided(w, own, *summed([row, code], n), m)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new), batch.column(2), batch.column(3)], schema=batch.schema)

    return rows.mapInArrow(run, rows.schema)


def moved(near: DataFrame, m: np.ndarray, classes, half, turn: int, several: bool, clustered: int, end: int, rare: list[DataFrame] = [], touched=None) -> DataFrame:
    """(w, class) of the words that leave their class; every second word may.

    Words move at the same time, so the caller looks at the likelihood after it.
    ``several``: whether some word has more than one row; those are summed first.  ``rare``
    has the mixed rows of words beyond the known ones (see ``with_classes``) and the others;
    summed first are also the former, and the neighbours of both, which ``touched`` marks by
    number.  A word goes to its task with a list of counts by code, not with its pairs.
    """
    n_classes = len(m)

    def going(batch: pa.RecordBatch, summed_first: bool) -> tuple[np.ndarray, ...]:
        if touched is not None:
            w, multi = (batch.column(j).to_numpy(zero_copy_only=False) for j in (0, 1))
            batch = batch.filter(pa.array((multi | ((w >= 0) & touched.value[np.maximum(w, 0)])) == summed_first))
        w, row, _, code, n = opened(batch, classes.value, n_classes)
        go = (w >= 0) & (half.value[np.maximum(w, 0)] == turn % 2)
        keep = go[row]
        return w, *summed([row[keep], code[keep]], n[keep])

    def changed(w: np.ndarray, own: np.ndarray, row: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        best = decided(w, own, row, code, n, m)
        go = np.flatnonzero(best != own)
        return pa.RecordBatch.from_arrays([pa.array(w[go]), pa.array(best[go])], ["w", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, row, code, n = going(batch, False)
            yield changed(w, classes_of(w, classes.value), row, code, n)

    def lists(w: np.ndarray, own: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        w, code, own, n = summed([w, code, own], n)
        first = np.flatnonzero(np.append(True, w[1:] != w[:-1])[: len(w)])
        ends = pa.array(np.append(first, len(w)).astype(np.int32))
        counted = (pa.ListArray.from_arrays(ends, pa.array(x)) for x in (code.astype(np.int16), n.astype(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(w[first].astype(np.int64)), pa.array(own[first].astype(np.int16)), *counted], ["w", "own", "code", "n"])

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, row, code, n = going(batch, True)
            yield lists(w[row], classes_of(w, classes.value)[row], code, n)

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alone = batch.schema.names[1] == "class"
            w, own, row, o, after, code, n = rare_codes(batch, classes.value, n_classes)
            # the neighbour has this word on its other side
            e = np.flatnonzero((o >= clustered) & (o != end))
            e = e[half.value[o[e]] == turn % 2]
            yield lists(o[e], classes.value[o[e]].astype(np.int64), own[row[e]] + (1 - after[e]) * n_classes, n[e])
            if not alone:
                go = (w & 1) == turn % 2
                yield lists(w[go], own[go], code[go], n[go])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []

        def out(rows: pa.Table) -> pa.RecordBatch:
            batch = rows.combine_chunks().to_batches()[0]
            w, own = (batch.column(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in (0, 1))
            row = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            of = np.repeat(np.arange(len(row)), np.diff(row, append=len(w)))
            code, n = (batch.column(j).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for j in (2, 3))
            of = np.repeat(of, batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
            return changed(w[row], own[row], *summed([of, code], n))

        for batch in batches:
            if not batch.num_rows:
                continue
            pending.append(batch)
            w = batch.column(0).to_numpy(zero_copy_only=False)
            # the last word may go on in the next batch
            cut = np.searchsorted(w, w[-1])
            if cut:
                yield out(pa.Table.from_batches([*pending[:-1], batch.slice(0, cut)]))
                pending[:] = [batch.slice(cut)]
        if pending:
            yield out(pa.Table.from_batches(pending))

    counted = "w long, own short, code array<short>, n array<long>"
    out = (near.where("NOT multi") if touched is None else near).mapInArrow(run, "w long, class long")
    if several or rare:
        # at most two counts a class for a word
        first = (near.where("multi AND w >= 0") if touched is None else near).mapInArrow(some, counted)
        for of in rare:
            first = first.unionByName(of.mapInArrow(beside, counted))
        out = out.unionByName(first.repartition("w").sortWithinPartitions("w").mapInArrow(listed, "w long, class long"))
    return out


def exchange(counts: np.ndarray, clustered: int, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each symbol.  Of the first ``clustered`` symbols the foremost start in classes of their own and the rest in
    the last one; one after the other moves to the class that raises the likelihood of the class bigrams most, until none
    does.  The other symbols keep classes of their own."""
    size = len(counts)
    classes = max(1, min(classes, clustered))
    at = np.concatenate([np.minimum(np.arange(clustered), classes - 1), classes + np.arange(size - clustered)])
    n = int(at.max(initial=0)) + 1

    def log(x):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    m = np.zeros((n, n))
    np.add.at(m, (at[:, None].repeat(size, 1), at[None, :].repeat(size, 0)), counts)
    for _ in range(rounds):
        moved = 0
        for w in range(clustered):
            right = np.bincount(at, counts[w], n)
            left = np.bincount(at, counts[:, w], n)
            same, c = float(counts[w, w]), at[w]
            m[c, :] -= right
            m[:, c] -= left
            m[c, c] += same
            right[c] -= same
            left[c] -= same
            # the other words' own counts: what they have with this word is there wherever it goes
            was, rows, cols = log(m), m.sum(1) + left, m.sum(0) + right
            gain = (log(m + right) - was).sum(1) + (log(m + left[:, None]) - was).sum(0)
            d = np.arange(n)
            gain += log(m[d, d] + right + left + same) - log(m[d, d] + right) - log(m[d, d] + left) + was[d, d]
            gain -= log(rows + right.sum() + same) - log(rows) + log(cols + left.sum() + same) - log(cols)
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[c] + 1e-9 * (1 + abs(gain[c])):
                best = c
            moved += best != c
            at[w] = best
            m[best, :] += right
            m[:, best] += left
            m[best, best] += same
        if not moved:
            break
    return at


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_fold: int = 2, clustered: int = CLUSTERED, classes: int = CLASSES, held_words: int = HELD, moves: int = MOVES, known_words: int | None = None, table_words: int = KNOWN
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity), one row per input row.

    Learns from the rows outside ``held_fold``.  ``base_score`` is the add-one unigram
    log10 probability; ``score`` that of the class model, the sum over tokens of
    log10 P(class | class before) + log10 P(word | class).  Word counts are of all
    training texts.  All training words have a class: the ``clustered`` most frequent by
    exchange, the others by ``moves`` rounds over the classes around them in all training
    texts; the assignment of the highest likelihood counts.  All training words move, unless
    ``known_words`` is given: then, beside the held words, that many of the most frequent
    ones (about equal counts all or none), and the others keep the class of their length.
    Words that were never seen have the class of their length.  A word moves where that
    gains more than naming its class costs.  Tasks hold the ``held_words`` most frequent
    words, and hashes, counts and classes of the next ``table_words`` (without those that occur
    once, if they are many), with the same result.  Of
    those beyond, most stand among such words alone: each is a row with its class and
    neighbours, which moves where it lies.  Only where two stand side by side do their
    pairs meet their classes by joins in every round.  What a document needs
    of words beyond those is one row per document and pair with such a word, joined
    with their counts and classes by a 63-bit hash.

    Null counts as empty: one token, the end.  Repeated rows each count and give a row,
    a null id falls in the fold of the empty text, no training rows leave the smoothing
    alone, an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "brown")
    d = id_and_text(docs, id_col, text_col).withColumn("held_out", fold(F.col("doc_id"), folds) == held_fold)
    train = d.where(~F.col("held_out"))
    counts = scratch.save(word_counts(train), "counts")
    top = frequent(counts.where(F.col("word") != END), held_words)
    held, held_n = [r["word"] for r in top], np.array([r["n"] for r in top], np.int64)
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_train, v_train = int(sums["n"]), int(sums["v"])
    ends = int(counts.where(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])

    words_held = spark.sparkContext.broadcast((held, clustered))
    symbols = Symbols(held, clustered)
    numbered = d.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    coded = scratch.save(encoded(numbered, words_held), "tokens", compression="zstd")
    learned = coded.where(~F.col("held_out"))
    pairs = np.zeros(symbols.size**2)
    # bounded by the square of the number of symbols
    for r in bigram_counts(learned, words_held).toLocalIterator():
        pairs[r["pair"]] = r["n"]
    pairs = pairs.reshape(symbols.size, symbols.size)
    at = exchange(pairs, symbols.clustered, classes)
    n_classes = int(at.max()) + 1

    # every other word starts in the class of its length and moves by the classes around it
    words = scratch.save(rest_and_held(counts, words_held, at), "words")
    others = words.where("w < 0")
    # the least eighth of a power of two from which words are known, so the driver gets no more than ``most`` of them
    most = table_words if known_words is None else known_words
    size_of = F.floor(F.log2("n") * 8)
    lowest, taken = 0, 0
    for r in sorted(others.groupBy(size_of.alias("b")).count().collect(), reverse=True):
        taken += r["count"]
        if taken > most or (known_words is None and r["b"] == 0 and r["count"] > ONCE):
            lowest = r["b"] + 1
            break
    firsts = others.where(size_of >= lowest).select("w", "class", "n").toArrow()
    order = np.argsort(firsts["w"].to_numpy())
    keys = firsts["w"].to_numpy()[order]
    known = spark.sparkContext.broadcast(keys)
    parts = np.append(1 + held_n // ROW_WORDS, 1)
    # words beyond the known ones: those with such neighbours as pairs, the others a row each with their class
    alone = rare = pairs_of = touched = None
    if known_words is None and others.where(size_of < lowest).limit(1).count():
        near = scratch.save(neighbours(learned, words_held, known, at, parts, apart=True), "neighbours", compression="zstd")
        packed = scratch.save(rare_rows(learned, words_held, known, at, others.where(size_of < lowest).select("w", "class")), "rare-rows", compression="zstd")
        alone, rare = packed.where("NOT mixed").select("w", "class", "o", "n"), packed.where("mixed").select("w", "class")
        pairs_of = rare_pairs(packed.where("mixed"))
        # numbers of known words, no more than tasks hold
        beside = np.zeros(len(held) + 1 + len(keys), bool)
        beside[numbers_beside(packed).toArrow()["o"].to_numpy()] = True
        touched = spark.sparkContext.broadcast(beside)
    else:
        near = scratch.save(neighbours(learned, words_held, known, at, parts), "neighbours", compression="zstd")
    several = bool((parts > 1).any())
    end = len(held)
    # classes by number; the held words' and the others' start is that of their length
    start = np.zeros(end + 1 + len(keys), np.uint8)
    start[: symbols.clustered], start[end] = at[: symbols.clustered], at[symbols.end]
    start[symbols.clustered : end] = at[symbols.held_symbols[symbols.clustered : end]]
    start[end + 1 :] = firsts["class"].to_numpy()[order]
    fixed = np.zeros((n_classes, n_classes), np.int64)
    own = np.append(np.arange(symbols.clustered), symbols.end)
    np.add.at(fixed, (at[own][:, None].repeat(len(own), 1), at[own][None, :].repeat(len(own), 0)), pairs[np.ix_(own, own)].astype(np.int64))
    # a word's half is that of its hash, held or not
    half = spark.sparkContext.broadcast(np.concatenate([rest_keys([w.encode() for w in [*held, END]]), keys]) & 1)
    best = best_likelihood = None
    now = start
    met = None
    for turn in range(moves + 1):
        sent = spark.sparkContext.broadcast(now)
        matrix = class_matrix(near, sent, symbols.clustered, end, fixed)
        beyond = []
        if rare is not None:
            if met is not None:
                scratch.drop(met)
            met = scratch.save(with_classes(pairs_of, rare), "rare-classes", compression="zstd")
            beyond = [met, alone]
            matrix = matrix + rare_matrix(beyond, sent, n_classes)
        if best is not None and likelihood(matrix) <= best_likelihood:
            break
        if best is not None and rare is not None:
            scratch.drop(*best[2:])
        best, best_likelihood = (now, matrix, rare, alone), likelihood(matrix)
        if turn < moves:
            gone = moved(near, matrix, sent, half, turn, several, symbols.clustered, end, beyond, touched)
            if rare is not None:
                gone = scratch.save(gone, "moved")
                left = gone.where("w < 0").select("w", F.col("class").alias("_to"))
                rare = scratch.save(rare.join(left, "w", "left").select("w", F.coalesce("_to", "class").alias("class")), "rare")
                alone = scratch.save(moved_alone(alone, matrix, sent, turn), "rare-alone", compression="zstd")
            gone = gone.where("w >= 0").toArrow()
            now = now.copy()
            now[gone["w"].to_numpy()] = gone["class"].to_numpy()
    classes_now, matrix, rare, alone = best
    # (w, class) of the words beyond the known ones
    unknown = others.where(size_of < lowest).select("w", "class") if rare is None else rare.unionByName(alone.select("w", "class"))
    scratch.drop(near)
    transition = np.log10((matrix + ALPHA) / (matrix.sum(1, keepdims=True) + ALPHA * n_classes))

    # emissions: add-one inside the class, with one more place for words that were never seen
    size = matrix.sum(0)
    kinds = np.bincount(at[: symbols.clustered], minlength=n_classes).astype(float)
    kinds += np.bincount(np.concatenate([classes_now[symbols.clustered : end], classes_now[end + 1 :]]), minlength=n_classes)
    for r in unknown.groupBy("class").count().collect():
        kinds[r["class"]] += r["count"]
    below = np.log10(size + kinds + 1)
    below[at[symbols.end]] = 0.0

    # by number: held words, the end, the known others
    word_logs = np.log10(np.concatenate([held_n, [ends], firsts["n"].to_numpy()[order]]) + 1.0)
    model = spark.sparkContext.broadcast((word_logs, classes_now, at, transition, below, ends > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, classes_now, at, transition, below, end_known = model.value
        sy = Known(*words_held.value, known.value, at)
        end = len(sy.place)
        for batch in batches:
            for part, key, symbol, text in tokens(batch, sy):
                n = part.num_rows
                rest = np.flatnonzero(key < 0)
                found = sy.looked_up(key[rest])
                key = key.copy()
                key[rest] = np.where(found >= 0, found, key[rest])
                # words beyond the known ones have the class of their length until the join
                cls = np.where(key >= 0, classes_now[np.maximum(key, 0)], at[symbol]).astype(np.int64)
                first, cls_first = sy.before(key, end), sy.before(cls, int(at[sy.end]))
                open_pair = (first < 0) | (key < 0)
                steps = np.where(open_pair, 0.0, transition[cls_first, cls] - below[cls])
                word = (key >= 0) & (key != end)
                steps[word] += logs[key[word]]
                known_word = word | ((key == end) & end_known)
                i = np.flatnonzero(open_pair)
                in_text, a, ca, b, cb, times = summed([text[i], first[i], cls_first[i], key[i], cls[i]], np.ones(len(i), np.int64))
                offsets = np.concatenate([[0], np.cumsum(np.bincount(in_text, minlength=n))]).astype(np.int32)
                entries = pa.StructArray.from_arrays([pa.array(x) for x in (a, ca, b, cb, times)], ["a", "ca", "b", "cb", "times"])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(j) for j in range(3)),
                        pa.array(np.bincount(text, minlength=n)),
                        pa.array(np.bincount(text, known_word, n).astype(np.int64)),
                        pa.array(np.bincount(text, np.where(key >= 0, logs[np.maximum(key, 0)], 0.0), n)),
                        pa.array(np.bincount(text, steps, n)),
                        pa.ListArray.from_arrays(pa.array(offsets), entries),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "steps", "rest"],
                )

    kind = d.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, steps double, rest array<struct<a:long,ca:long,b:long,cb:long,times:long>>"
    scored = scratch.save(coded.mapInArrow(run, schema), "scored")
    scratch.drop(coded)
    unheld = others.where(size_of < lowest).select("w", "n").join(unknown, "w").select("w", "class", F.log10(F.col("n") + 1.0).alias("log"))
    unheld = scratch.save(unheld, "unheld")
    rest = scored.select("row", F.explode("rest").alias("p")).select("row", "p.*")

    def sent_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, _, transition, below, _ = model.value
        for batch in batches:
            row, ca, cb, times = (batch.column(j).to_numpy(zero_copy_only=False) for j in range(4))
            log = batch.column(4).fill_null(0.0).to_numpy(zero_copy_only=False)
            seen = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            rows, at_row = np.unique(row, return_inverse=True)
            cols = np.bincount(at_row, seen * times), np.bincount(at_row, times * log), np.bincount(at_row, times * (transition[ca, cb] - below[cb]))
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(cols[0].astype(np.int64)), pa.array(cols[1]), pa.array(cols[2])], ["row", "known", "more", "steps_open"])

    # only words beyond the known ones take part in the joins, and none of them is frequent
    one = rest.where("a < 0").join(unheld.select(F.col("w").alias("a"), F.col("class").alias("_ca")), "a", "left").select("row", F.coalesce("_ca", "ca").alias("ca"), "b", "cb", "times")
    one = one.unionByName(rest.where("a >= 0").select("row", "ca", "b", "cb", "times"))
    two = one.where("b < 0").join(unheld.select(F.col("w").alias("b"), F.col("class").alias("_cb"), "log"), "b", "left").select("row", "ca", F.coalesce("_cb", "cb").alias("cb"), "times", "log")
    two = two.unionByName(one.where("b >= 0").select("row", "ca", "cb", "times", F.lit(None).cast("double").alias("log")))
    found = two.select("row", "ca", "cb", "times", "log").mapInArrow(sent_on, "row long, known long, more double, steps_open double")
    found = found.groupBy("row").agg(F.sum("known").alias("known"), F.sum("more").alias("more"), F.sum("steps_open").alias("steps_open"))
    out = scored.drop("rest").join(found, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    score = F.col("steps") + more + F.coalesce("steps_open", F.lit(0.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(float(np.log10(n_train + v_train + 1.0)))).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
