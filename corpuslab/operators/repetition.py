"""Find and collapse runaway repetitions in word sequences.

A phrase of ``k`` words that repeats ``r`` times in a row is a run of positions
``i`` with ``w[i] = w[i + k]`` of length at least ``(r - 1) * k``; ``loops`` finds
them.  Windows serve the report; what is merged and cleaned is found in whole
transcripts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import LINEAR_SVM, linear_score
from ..session import materialize
from .loops import runs_in_rows, transcript_runs
from .ranges import overlap_join
from .running import running, running_number

WINDOW_WORDS = 500
OVERLAP_PERCENT = 25.0
MIN_REPETITIONS = 5


def repeated_runs(df: DataFrame, words: str, min_repetitions: int = MIN_REPETITIONS) -> DataFrame:
    """Maximal runs at their primitive period, one row each:
    ``start, k, repetitions, run_end, reach``; ``run_end`` is after the last full
    repetition, ``reach`` after the last word that still follows the period.
    Rows keep the other columns of ``df`` and the word array; a row's words are one text."""
    return runs_in_rows(df, words, min_repetitions)


def classify(runs: DataFrame, coefficients: tuple[float, float, float] = LINEAR_SVM) -> DataFrame:
    """Keep runs with a positive decision score."""
    score = linear_score(F.col("repetitions"), F.col("k"), coefficients)
    return runs.withColumn("score", score).where(F.col("score") > 0)


def outermost(hits: DataFrame, scope: list[str]) -> DataFrame:
    """Largest k per start, then drop hits contained in an earlier one.

    ``scope`` names one window or one text, so a group is bounded.
    """
    per_start = Window.partitionBy(*scope, "start").orderBy(F.desc("k"))
    best = hits.withColumn("__r", F.row_number().over(per_start)).where("__r = 1").drop("__r")
    before = Window.partitionBy(*scope).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("run_end").over(before)
    return best.withColumn("__m", reach).where(F.col("__m").isNull() | (F.col("run_end") > F.col("__m"))).drop("__m")


def first_hit(hits: DataFrame, scope: list[str]) -> DataFrame:
    """The first hit per scope (one window or one text)."""
    cols = [c for c in hits.columns if c not in scope]
    picked = F.min_by(F.struct(*cols), F.struct("start", -F.col("k"))).alias("__h")
    return hits.groupBy(*scope).agg(picked).select(*scope, "__h.*")


def word_windows(
    cues: DataFrame, key: str, order: str, words: str, size: int = WINDOW_WORDS, overlap: float = OVERLAP_PERCENT
) -> DataFrame:
    """Fixed-stride word windows over a transcript: ``window_id``,
    ``window_start`` and the word array.

    Cues need ``word_start``/``word_end``.  Each cue sends the slice of its
    words that falls into a window, so a group holds at most ``size`` words.
    A window that lies wholly inside its predecessor is left out.
    """
    keep = int(size * overlap / 100)
    stride = size - keep
    cue_from, cue_to = F.col("word_start"), F.col("word_end")
    first = F.greatest(F.lit(0), F.floor((cue_from - size) / stride) + 1).cast("long")
    last = F.floor((cue_to - 1) / stride).cast("long")
    spread = cues.where(cue_to > cue_from).withColumn("window_id", F.explode(F.sequence(first, last)))
    at = F.col("window_id") * stride
    lo = F.greatest(at, cue_from)
    hi = F.least(at + size, cue_to)
    piece = F.slice(F.col(words), (lo - cue_from + 1).cast("int"), (hi - lo).cast("int"))
    pieces = spread.select(key, "window_id", F.col(order).alias("__o"), piece.alias("__p"))
    merged = pieces.groupBy(key, "window_id").agg(F.array_sort(F.collect_list(F.struct("__o", "__p"))).alias("__l"))
    out = merged.select(
        key,
        "window_id",
        (F.col("window_id") * stride).alias("window_start"),
        F.flatten(F.transform("__l", lambda s: s["__p"])).alias("words"),
    )
    return out.where((F.col("window_id") == 0) | (F.size("words") > keep))


def window_hits(windows: DataFrame, key: str, min_repetitions: int = MIN_REPETITIONS) -> DataFrame:
    """Classified hits per window in transcript positions: ``hit_start,
    hit_end, hit_reach`` next to the window-local ``start, run_end``, plus
    ``pattern``."""
    runs = classify(repeated_runs(windows, "words", min_repetitions))
    kept = runs.withColumn(
        "pattern", F.array_join(F.slice("words", (F.col("start") + 1).cast("int"), F.col("k").cast("int")), " ")
    ).withColumn("window_words", F.size("words").cast("long")).drop("words")
    hits = outermost(kept, [key, "window_id"])
    return hits.withColumns(
        {
            "hit_start": F.col("window_start") + F.col("start"),
            "hit_end": F.col("window_start") + F.col("run_end"),
            "hit_reach": F.col("window_start") + F.col("reach"),
        }
    )


def transcript_hits(cues: DataFrame, key: str, order: str, words: str, min_repetitions: int = MIN_REPETITIONS) -> DataFrame:
    """Classified runs of whole transcripts that do not overlap: ``hit_start, hit_end, k, repetitions``.

    Of runs with one start the longest is taken, then of runs that overlap the earliest;
    what it covers is dropped.
    """
    runs = classify(transcript_runs(cues, key, order, words, min_repetitions))
    best = F.max_by(F.struct(F.col("run_end").alias("hit_end"), "k", "repetitions"), F.struct("run_end", "k")).alias("__b")
    per_start = materialize(runs.groupBy(key, F.col("start").alias("hit_start")).agg(best).select(key, "hit_start", "__b.*"), "hit-runs")
    covered = running(per_start, [key], "hit_start", F.col("hit_end"), "__reach", how="max", inclusive=False)
    return covered.where(F.col("__reach").isNull() | (F.col("hit_start") >= F.col("__reach"))).drop("__reach")


def hit_cue_spans(hits: DataFrame, cues: DataFrame, key: str, order: str) -> DataFrame:
    """First and last cue of every hit with their times, and the joined text of
    the first occurrence's cues."""
    rows = cues.select(key, F.col(order).alias("__o"), "content", "word_start", "word_end", "start_ms", "end_ms")
    pairs = overlap_join(rows, hits, [key], ("word_start", "word_end"), ("hit_start", "hit_end"))
    cols = [c for c in hits.columns if c != key]
    return pairs.groupBy(key, *cols).agg(
        F.min("__o").alias("cue_from"),
        F.max("__o").alias("cue_to"),
        F.min("start_ms").alias("hit_start_ms"),
        F.max("end_ms").alias("hit_end_ms"),
        F.count(F.lit(1)).alias("n_cues"),
        # the cues of one occurrence are few, however long the loop is
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.when(F.col("word_start") < F.col("hit_start") + F.col("k"), F.struct("__o", "content")))), lambda c: c["content"]), " "
        ).alias("text"),
    )


def collapse_in_cues(cues: DataFrame, hits: DataFrame, key: str, order: str, words: str) -> DataFrame:
    """Cleaned cues after every hit is cut down to one occurrence.

    Cues that share a hit form a cluster.  The words that survive (text before
    the run, one phrase, text after it) go to the first cue of the cluster, the
    others are emptied; empty cues are dropped and the rest renumbered.  Words
    are removed by position, so a cluster carries only its survivors.
    """
    cut = hits.select(
        key,
        (F.col("hit_start") + F.col("k")).alias("__cut_from"),
        F.col("hit_end").alias("__cut_to"),
        F.col("hit_start").alias("__hs"),
    )
    base = cues.select(key, order, "start_ms", "end_ms", "word_start", "word_end", words)
    ids = base.select(key, F.col(order).alias("__o"), "word_start", "word_end")
    touched = overlap_join(ids, hits.select(key, "hit_start", "hit_end"), [key], ("word_start", "word_end"), ("hit_start", "hit_end"))
    touched = materialize(touched.select(key, "__o", "hit_start"), "touched-cues")
    spans = touched.groupBy(key, "hit_start").agg(F.min("__o").alias("__a"), F.max("__o").alias("__b"))
    reach = running(spans, [key], "hit_start", F.col("__b"), "__reach", how="max", inclusive=False)
    heads = running(
        reach.withColumn("__new", F.when(F.col("__reach").isNull() | (F.col("__a") > F.col("__reach")), F.col("__a"))),
        [key], "hit_start", F.col("__new"), "__head", how="last",
    )
    owner = (
        touched.select(key, "__o", "hit_start")
        .join(heads.select(key, "hit_start", "__head"), [key, "hit_start"])
        .groupBy(key, "__o")
        .agg(F.min("__head").alias("__head"))
    )
    cuts = (
        overlap_join(ids, cut.where("__cut_to > __cut_from"), [key], ("word_start", "word_end"), ("__cut_from", "__cut_to"))
        .groupBy(key, "__o")
        .agg(F.collect_list(F.struct("__cut_from", "__cut_to")).alias("__cuts"))
    )
    marked = (
        base.join(owner.withColumnRenamed("__o", order), [key, order], "left")
        .join(cuts.withColumnRenamed("__o", order), [key, order], "left")
    )
    alive = F.filter(
        F.col(words),
        lambda x, i: ~F.exists(
            F.coalesce(F.col("__cuts"), F.array().cast("array<struct<__cut_from:bigint,__cut_to:bigint>>")),
            lambda c: (F.col("word_start") + i >= c["__cut_from"]) & (F.col("word_start") + i < c["__cut_to"]),
        ),
    )
    left = marked.withColumn("__alive", alive)
    moved = (
        left.where(F.col("__head").isNotNull() & (F.size("__alive") > 0))
        .groupBy(key, F.col("__head").alias(order))
        .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("__o"), "__alive"))).alias("__l"))
        .select(key, order, F.flatten(F.transform("__l", lambda s: s["__alive"])).alias("__joined"))
    )
    text = F.when(F.col("__head").isNull(), F.array_join("__alive", " ")).when(
        F.col("__head") == F.col(order), F.array_join(F.coalesce("__joined", F.array().cast("array<string>")), " ")
    ).otherwise(F.lit(""))
    cleaned = left.join(moved, [key, order], "left").withColumn("content", text).where(F.col("content") != "")
    kept = cleaned.select(
        key, order, "start_ms", "end_ms", "content", F.col("__head").isNotNull().alias("was_cleaned")
    )
    return running_number(materialize(kept, "cleaned-cues"), [key], order, "new_index")


def training_rows(texts: DataFrame, key: str, words: str) -> DataFrame:
    """Per text the hit with the largest k x repetitions: ``repetitions,
    sequence_length, area``; zeros where there is none."""
    hits = outermost(classify(repeated_runs(texts.select(key, words), words)).drop(words), [key])
    area = F.col("k") * F.col("repetitions")
    best = hits.groupBy(key).agg(
        F.max_by(F.struct("k", "repetitions", area.alias("area")), F.struct(area, -F.col("start"))).alias("__b")
    )
    out = texts.select(key).join(best, key, "left")
    return out.select(
        key,
        *[
            F.coalesce(F.col("__b")[src], F.lit(0)).cast("long").alias(dst)
            for src, dst in (("repetitions", "repetitions"), ("k", "sequence_length"), ("area", "area"))
        ],
    )


def detection_summary(windows: DataFrame, hits: DataFrame, key: str, transcripts: DataFrame) -> DataFrame:
    """One row: transcripts seen, with hits, failed (no window came of them), hits in
    all, windows evaluated."""
    seen = windows.groupBy(key).agg(F.count(F.lit(1)).alias("__w"))
    with_hits = hits.groupBy(key).agg(F.count(F.lit(1)).alias("__h"))
    return transcripts.select(key).distinct().join(seen, key, "left").join(with_hits, key, "left").agg(
        F.count("__w").alias("files_processed"),
        F.count_if(F.col("__w").isNull()).alias("files_failed"),
        F.count("__h").alias("files_with_hits"),
        F.coalesce(F.sum("__h"), F.lit(0)).alias("total_hits"),
        F.sum("__w").alias("total_windows"),
    )
