"""Timed cues: parsing, word offsets, time lookups, plain text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_ws, words
from ..functions.times import CUE_TIME, cue_time_ms
from ..session import materialize
from .ranges import overlap_join, point_join
from .running import running, running_number

CUE_BLOCK = r"(?s)^[ \t]*([0-9]+)[ \t]*\n[ \t]*(" + CUE_TIME + r")[ \t]*-->[ \t]*(" + CUE_TIME + r")[^\n]*\n?(.*)$"


def parse_cues(files: DataFrame, text: str = "text") -> DataFrame:
    """Cue rows of subtitle files: ``cue_index, start_ms, end_ms, content``.

    Blocks are split at a blank line that is followed by the next cue head, so
    blank lines inside a cue do not cut it.
    """
    body = F.regexp_replace(F.col(text), "\r\n?", "\n")
    blocks = F.split(body, r"\n[ \t]*\n(?=[ \t]*[0-9]+[ \t]*\n[ \t]*[0-9]+:[0-9]{2}:[0-9]{2}[,.][0-9]{3}[ \t]*-->)")
    keep = [c for c in files.columns if c != text]
    rows = files.select(*keep, F.explode(blocks).alias("__b"))
    b = F.regexp_replace(F.col("__b"), r"^\s+", "")
    return rows.where(b.rlike(CUE_BLOCK)).select(
        *keep,
        F.regexp_extract(b, CUE_BLOCK, 1).cast("long").alias("cue_index"),
        cue_time_ms(F.regexp_extract(b, CUE_BLOCK, 2)).alias("start_ms"),
        cue_time_ms(F.regexp_extract(b, CUE_BLOCK, 7)).alias("end_ms"),
        strip_ws(F.regexp_extract(b, CUE_BLOCK, 12)).alias("content"),
    )


def word_offsets(cues: DataFrame, key: str, order: str, content: Column) -> DataFrame:
    """Add ``n_words`` and the half-open word span ``word_start, word_end`` in
    the transcript."""
    counted = cues.withColumn("n_words", F.size(words(content)).cast("long"))
    return running(counted, [key], order, F.col("n_words"), "word_end").withColumn(
        "word_start", F.col("word_end") - F.col("n_words")
    )


def transcript_ends(cues: DataFrame, key: str, order: str) -> DataFrame:
    """Last cue end per transcript."""
    return cues.groupBy(key).agg(F.max_by("end_ms", order).alias("last_end_ms"))


def word_to_time(points: DataFrame, cues: DataFrame, key: str, order: str, point: str) -> DataFrame:
    """Start of the cue that holds a word position; past the last word the end
    of the last cue; 0 for a transcript without cues."""
    spans = cues.select(key, "word_start", "word_end", "start_ms")
    placed = point_join(points, spans, [key], point, ("word_start", "word_end"))
    return (
        placed.join(transcript_ends(cues, key, order), key, "left")
        .withColumn("time_ms", F.coalesce("start_ms", "last_end_ms", F.lit(0)))
        .drop("word_start", "word_end", "start_ms", "last_end_ms")
    )


def cues_inside(cues: DataFrame, spans: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Cues fully inside a time span of the same transcript.

    ``spans`` carries integer ``start``/``end`` columns in milliseconds.
    """
    pairs = overlap_join(cues, spans, [key], ("start_ms", "end_ms"), (start, end), width=1 << 16)
    return pairs.where((F.col("start_ms") >= F.col(start)) & (F.col("end_ms") <= F.col(end)))


def span_text(cues: DataFrame, nodes: DataFrame, key: str, order: str, content: str, node_keys: list[str]) -> DataFrame:
    """Joined text and start of each node's cue index span [from_idx, to_idx).

    Nodes are leaf spans, so a group is one leaf.  ``in_bounds`` is false when
    the span leaves the transcript.
    """
    rows = cues.select(key, F.col(order).alias("__i"), (F.col(order) + 1).alias("__j"), content, "start_ms")
    pairs = overlap_join(rows, nodes, [key], ("__i", "__j"), ("from_idx", "to_idx"))
    texts = pairs.groupBy(key, *node_keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("__i", content))), lambda s: s[content]), " "
        ).alias("node_text"),
        F.min_by("start_ms", "__i").alias("node_start_ms"),
    )
    sizes = cues.groupBy(key).agg((F.max(order) + 1).alias("n_cues"))
    return (
        nodes.join(texts, [key, *node_keys], "left")
        .join(sizes, key, "left")
        .withColumn("in_bounds", F.coalesce(F.col("to_idx") <= F.col("n_cues"), F.lit(False)))
        .drop("n_cues")
    )


def plain_lines(cues: DataFrame, content: str) -> DataFrame:
    """Stripped non-empty cue lines; the row-per-line form of the plain text,
    which keeps a long transcript spread over tasks."""
    return cues.withColumn("line", strip_ws(content)).where(F.col("line") != "")


def plain_text_files(files: DataFrame, text: str) -> DataFrame:
    """Plain text of whole subtitle files, row by row; ``error`` where a file
    holds no cue."""
    body = F.regexp_replace(F.col(text), "\r\n?", "\n")
    blocks = F.split(body, r"\n[ \t]*\n(?=[ \t]*[0-9]+[ \t]*\n[ \t]*[0-9]+:[0-9]{2}:[0-9]{2}[,.][0-9]{3}[ \t]*-->)")
    cues = F.filter(F.transform(blocks, lambda b: F.regexp_replace(b, r"^\s+", "")), lambda b: b.rlike(CUE_BLOCK))
    lines = F.filter(F.transform(cues, lambda b: strip_ws(F.regexp_extract(b, CUE_BLOCK, 12))), lambda x: x != "")
    return files.withColumn("__n", F.size(cues)).withColumns(
        {
            "plain_text": F.when(F.col("__n") > 0, F.array_join(lines, "\n")),
            "error": F.when(F.col("__n") == 0, F.lit("no cues found")),
        }
    ).drop("__n", text)


def hours_by_channel(cues: DataFrame, channel: str, key: str) -> DataFrame:
    """Files and summed end time (whole seconds) per channel."""
    ends = cues.groupBy(channel, key).agg(F.floor(F.max("end_ms") / 1000).cast("long").alias("end_s"))
    return ends.groupBy(channel).agg(F.count(F.lit(1)).alias("n_files"), F.sum("end_s").alias("total_s"))


def _first_at_least(points: DataFrame, asked: DataFrame, key: str, at: str, value: str, out: str) -> DataFrame:
    """(key, at, out): for each asked place the ``value`` of the first point at or behind it; null past the last one.

    Points and places are put in one descending order and filled forward.
    """
    both = points.select(key, (-2 * F.col(at) - 1).alias("__o"), F.col(value).alias("__v")).unionByName(
        asked.select(key, (-2 * F.col(at)).alias("__o")).distinct(), allowMissingColumns=True
    )
    filled = running(materialize(both, "places"), [key], "__o", F.col("__v"), "__last", how="last")
    return filled.where(F.col("__o") % 2 == 0).select(key, F.expr("-__o div 2").alias(at), F.col("__last").alias(out))


def cue_windows(cues: DataFrame, key: str, order: str, size: int = 500, overlap: float = 25.0) -> DataFrame:
    """Windows that grow and shrink by whole cues: ``window_index, cue_from, cue_to,
    window_start, window_end``, the last two in words.

    A window takes cues until it has ``size`` words or the transcript ends; then cues leave
    at its front until at most ``overlap`` percent of ``size`` words are left, and the next
    window grows from there.  Cues need ``word_start`` and ``word_end``; ``order`` must be an
    integer, unique per transcript.

    Where the next window ends depends only on where one ends, and prefix sums tell it
    for every cue.  The ends that are reached from the first one come by doubling these
    pointers, so no task goes through a transcript, however long it is.
    """
    if not 0 <= overlap < 100 or size < 1:
        raise ValueError("size must be positive and overlap from 0 to below 100 percent")
    keep = int(size * overlap / 100)
    base = materialize(cues.where(F.col(key).isNotNull()).select(key, F.col(order).cast("long").alias("__i"), "word_start", "word_end"), "cue-spans")
    last = base.groupBy(key).agg(F.max("__i").alias("__end"))
    # where a window begins again behind each cue, then where it ends; one row for each place
    starts = base.groupBy(key, F.col("word_start").alias("__s")).agg(F.min("__i").alias("__i")).withColumn("__v", F.struct("__s", "__i"))
    again = base.withColumn("__s", F.col("word_end") - keep)
    again = again.join(_first_at_least(starts, again, key, "__s", "__v", "__from"), [key, "__s"], "left").drop("__s")
    again = again.where("__from IS NOT NULL").select(key, "__i", F.col("__from.__i").alias("__a"), F.col("__from.__s").alias("__as"))
    ends = base.groupBy(key, F.col("word_end").alias("__s")).agg(F.min("__i").alias("__v"))
    asked = again.withColumn("__s", F.col("__as") + size)
    first = base.select(key).distinct().withColumn("__s", F.lit(size).cast("long"))
    found = materialize(_first_at_least(ends, asked.select(key, "__s").unionByName(first), key, "__s", "__v", "__next"), "window-ends")
    ahead = asked.join(found, [key, "__s"], "left").join(last, key)
    step = ahead.where(F.col("__i") < F.col("__end")).select(key, "__i", "__a", "__as", F.coalesce("__next", "__end").alias("__next"))
    step = materialize(step, "window-steps")
    begun = first.join(found, [key, "__s"], "left").join(last, key).select(key, F.coalesce("__next", "__end").alias("__i"))

    reached, jump = materialize(begun, "reached"), step.select(key, "__i", "__next")
    while not jump.isEmpty():
        reached = materialize(reached.unionByName(reached.join(jump, [key, "__i"]).select(key, F.col("__next").alias("__i"))), "reached")
        after = jump.select(key, F.col("__i").alias("__next"), F.col("__next").alias("__then"))
        jump = materialize(jump.join(after, [key, "__next"]).select(key, "__i", F.col("__then").alias("__next")), "jumps")

    placed = reached.join(step.select(key, "__i", F.struct("__a", "__as").alias("__begin")), [key, "__i"], "left")
    placed = materialize(placed.join(base.select(key, "__i", "word_end"), [key, "__i"]), "windows")
    numbered = running_number(placed, [key], "__i", "__n")
    lead = base.groupBy(key).agg(F.min("__i").alias("__first"))
    whole = running(materialize(numbered, "windows"), [key], "__i", F.col("__begin"), "__came", how="last", inclusive=False).join(lead, key)
    return whole.select(
        key, (F.col("__n") - 1).alias("window_index"), F.coalesce("__came.__a", "__first").alias("cue_from"), F.col("__i").alias("cue_to"),
        F.coalesce("__came.__as", F.lit(0)).cast("long").alias("window_start"), F.col("word_end").alias("window_end"),
    )
