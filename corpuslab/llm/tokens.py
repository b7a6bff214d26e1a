"""Token counts of texts of any length: overlapping chunks that resynchronise."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import Memo, groups, id_and_text

#: Characters that a chunk owns, and characters beyond them in which it meets the next chunk.
CHUNK = 32_768
OVERLAP = 512
WIDEN = 8
#: Bytes of each of the memo's two generations, which a task leaves empty.
MEMO_BYTES = 32 << 20
MARK = "▁"
SEGMENT = re.compile(" *[^ ]+| +")


class PieceCounter:
    """Tokens under one sentencepiece model with identity normalisation.

    The texts here carry the space that the model puts in front, and its space mark as
    a plain space.  A border between two characters is *proven* when no piece of the
    vocabulary has these two next to each other: no merge can cross it, whatever
    stands around, so the text may be encoded apart on both sides of it.
    """

    def __init__(self, path: str):
        m = self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(m.vocab_size())
        pieces = [m.id_to_piece(i).replace(MARK, " ") for i in ids]
        plain = [p for i, p in zip(ids, pieces) if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i))]
        self.joined = {p[i : i + 2] for p in plain for i in range(len(p) - 1)}
        self.space_is_border = not any(x[1] == " " != x[0] for x in self.joined)
        #: Bytes of text that each token stands for.
        self.width = np.array([1 if m.is_byte(i) else len(p.encode()) for i, p in zip(ids, pieces)], np.int64)
        self.memo = Memo(MEMO_BYTES)

    def count_segments(self, segments: list[str]) -> list[int]:
        # each segment begins with the space that the model adds again; a lone space is one token
        made = self.model.encode([s[1:] for s in segments], num_threads=1)
        return [len(x) if s != " " else 1 for s, x in zip(segments, made)]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts; an empty text is given without the space and has none."""
        rows = [(SEGMENT.findall(t) if self.space_is_border else [t]) if t else [] for t in texts]
        known = self.memo.get((s for row in rows for s in row), self.count_segments)
        return [sum([known[s] for s in row]) for row in rows]

    def border(self, text: str, start: int, stop: int) -> int | None:
        """First proven border in ``start < p < stop``, one before a space if there is any; None without one."""
        inside = range(max(1, start + 1), min(stop, len(text)))
        proven = [p for p in inside if text[p - 1 : p + 1] not in self.joined]
        return next((p for p in proven if text[p] == " "), proven[0] if proven else None)

    def ends(self, text: str) -> np.ndarray:
        """Byte offsets at which the tokens of a chunk end, in the chunk without the space that the model adds."""
        return np.cumsum(self.width[np.array(self.model.encode(text, num_threads=1), np.int64)]) - 1

    def splice(self, text: str, own: int, overlap: int, first: bool, last: bool) -> tuple[int, int, int, bool]:
        """(begin, end, tokens between, aligned) of a chunk that owns ``own`` characters of ``text``.

        It begins at the border that it shares with the chunk before it, and ends at
        the one it shares with the next; both chunks look for a border in the same
        characters.  Not aligned when the overlap has no proven border, or an encoding
        goes across it.
        """
        begin = 0 if first else self.border(text, 0, overlap)
        end = len(text) if last else self.border(text, own, own + overlap)
        if begin is None and last and len(text) <= overlap:
            begin = len(text)  # the overlap of the chunk before reached the end of the text
        if begin is None or end is None:
            return 0, 0, 0, False
        ends = self.ends(text[1:] if first else text) + (1 if first else 0)
        at_begin, at_end = len(text[:begin].encode("utf-8", "surrogatepass")), len(text[:end].encode("utf-8", "surrogatepass"))
        known = {0, *ends.tolist()} if first else set(ends.tolist())
        aligned = (at_begin in known or begin == len(text)) and at_end in known
        return begin, end, int(((ends > at_begin) & (ends <= at_end)).sum()), aligned


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    """One counter and memo per Python worker."""
    return PieceCounter(path)


def _whole(docs: DataFrame, path: str) -> DataFrame:
    """Counts of texts that fit one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        try:
            for batch in batches:
                for part, texts in groups(batch):
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(c.count(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
        finally:
            c.memo.clear()

    return docs.select("doc_id", "n_bytes", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")


def _chunks(docs: DataFrame, own: int, overlap: int) -> DataFrame:
    """(doc_id, sha, n_bytes, chunk, first, last, piece): overlapping pieces of the texts, dealt over all tasks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "sha", "n_bytes", "chunk", "first", "last", "piece"]
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(3)[i].as_py()
                n = max(1, -(-len(text) // own))
                for k in range(n):
                    piece = text[k * own : (k + 1) * own + overlap]
                    # a chunk whose overlap takes in the rest of the text still ends at its border: the next one begins there
                    row = [pa.array([k], pa.int32()), pa.array([k == 0]), pa.array([k == n - 1]), pa.array([piece])]
                    yield pa.RecordBatch.from_arrays([*(batch.column(j).slice(i, 1) for j in range(3)), *row], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "sha", "n_bytes", "text").mapInArrow(cut, f"doc_id {kind}, sha string, n_bytes long, chunk int, first boolean, last boolean, piece string")
    return rows.repartition("doc_id", "sha", "chunk")


def _spliced(docs: DataFrame, path: str, own: int, overlap: int) -> DataFrame:
    """(doc_id, sha, n_bytes, n_tokens, n_rows, aligned) of each text, from its chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            rows = zip(*(batch.column(j).to_pylist() for j in (4, 5, 6)))
            found = [c.splice(piece, own, overlap, first, last) for first, last, piece in rows]
            begin, end, n, aligned = zip(*found)
            made = [pa.array(begin, pa.int64()), pa.array(end, pa.int64()), pa.array(n, pa.int64()), pa.array(aligned)]
            yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in (0, 1, 2, 3, 5)), *made], ["doc_id", "sha", "n_bytes", "chunk", "last", "begin", "end", "n", "aligned"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = _chunks(docs, own, overlap).mapInArrow(run, f"doc_id {kind}, sha string, n_bytes long, chunk int, last boolean, begin long, end long, n long, aligned boolean")
    at = F.col("chunk").cast("long") * own
    # neighbours must meet at one place: the ends of all but the last chunk are the beginnings of all but the first
    open_ends = F.sum(F.when(~F.col("last"), at + F.col("end")).otherwise(0)) - F.sum(F.when(F.col("chunk") > 0, at + F.col("begin")).otherwise(0))
    return parts.groupBy("doc_id", "sha", "n_bytes").agg(
        F.sum("n").alias("n"),
        F.sum((F.col("chunk") == 0).cast("long")).alias("n_rows"),
        (F.min("aligned") & (open_ends == 0)).alias("aligned"),
    ).withColumn("n_tokens", (F.col("n") / F.col("n_rows")).cast("long"))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text, one row per input row.

    Texts of more than ``chunk`` characters are cut into overlapping chunks that are
    encoded in different tasks and spliced at proven borders; texts whose chunks do not
    align are cut again with ``WIDEN`` times the overlap until they do, at the latest
    when the overlap reaches the end of the text.  Null counts as empty: no bytes, no
    tokens.  Repeated rows each give a row, null ids pass through, an empty table gives
    no rows.
    """
    d = id_and_text(docs, id_col, text_col)
    size = F.octet_length("text").cast("long")
    spaced = F.when(F.length("text") > 0, F.concat(F.lit(" "), F.replace("text", F.lit(MARK), F.lit(" ")))).otherwise("")
    d = d.select("doc_id", size.alias("n_bytes"), F.sha2(F.when(F.length("text") > chunk, F.col("text")).cast("binary"), 256).alias("sha"), spaced.alias("text"), (F.length("text") > chunk).alias("long_text"))
    out = _whole(d.where(~F.col("long_text")), path)
    pending = d.where("long_text")
    scratch, own, reach = Scratch(docs.sparkSession, "token-counts"), chunk, overlap
    while True:
        tried = scratch.save(_spliced(pending, path, own, reach), "spliced")
        done = tried.where("aligned")
        out = out.unionByName(done.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_rows")))).select("doc_id", "n_bytes", "n_tokens"))
        failed = tried.where(~F.col("aligned"))
        if failed.isEmpty():
            break
        reach *= WIDEN
        own = max(own, reach)
        pending = d.where("long_text").join(failed.select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha")), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")), "left_semi")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
