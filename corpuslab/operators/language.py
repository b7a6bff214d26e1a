"""Language chunks and profiles.

The predictor is a naive Bayes model over character trigrams, trained by
aggregation and applied by joins; it stands in for a pre-trained model.  A user
can bring a model through ``predict_with``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import letter_words, strip_ws, words
from ..session import materialize

CHUNK_WORDS = 1000
MIN_CONFIDENCE = 0.7
ENGLISH_SHARE = 0.8
#: Grams of the model that a task holds; the others meet the texts by a join.
HELD_GRAMS = 1_000_000
#: Characters that a task counts together, and distinct grams that it holds before it hands them on.
READ_CHARS, FLUSH_GRAMS = 1 << 20, 1 << 20


def chunks(docs: DataFrame, keys: list[str], text: str, target: int = CHUNK_WORDS) -> DataFrame:
    """Chunks of ``target`` words.  A short tail is replaced by the last
    ``target`` words; a text below ``target`` words is one chunk."""
    rows = docs.select(*keys, text, words(F.col(text)).alias("__w"))
    n = F.size("__w")
    last = F.ceil(n / target).cast("int") - 1
    spread = rows.select(*keys, text, "__w", F.explode(F.when(n > 0, F.sequence(F.lit(0), last))).alias("__i"))
    start = F.least(F.col("__i") * target, F.greatest(n - target, F.lit(0)))
    body = F.array_join(F.slice("__w", start + 1, target), " ")
    return spread.select(
        *keys,
        F.col("__i").cast("long").alias("chunk"),
        F.when(n < target, strip_ws(F.col(text))).otherwise(body).alias("chunk_text"),
    )


def _spaced(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, spaced): the words that hold a letter, lower-cased, with a blank at either end; null if there is none."""
    alpha = F.nullif(letter_words(F.col(text)), F.lit(""))
    return df.select(*keys, F.concat(F.lit(" "), F.lower(alpha), F.lit(" ")).alias("__spaced"))


def _coded(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of ``_spaced``: (rows, trigrams as numbers of three code points, row of each)."""
    texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
    total = np.cumsum([len(t) for t in texts])
    cuts = np.flatnonzero(np.diff(total // READ_CHARS, append=-1)) + 1
    for start, stop in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
        chars = np.frombuffer("".join(texts[start:stop]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        row = np.repeat(np.arange(stop - start), [len(t) for t in texts[start:stop]])
        inside = row[2:] == row[:-2]
        code = (chars[:-2] << 42) | (chars[1:-1] << 21) | chars[2:]
        yield batch.slice(start, stop - start), code[inside], row[2:][inside]


def _grams(codes: np.ndarray) -> pa.Array:
    chars = np.stack([codes >> 42, (codes >> 21) & 0x1FFFFF, codes & 0x1FFFFF], 1).astype(np.uint32)
    flat = chars.tobytes().decode("utf-32-le", "surrogatepass")
    return pa.array([flat[i : i + 3] for i in range(0, len(flat), 3)], pa.string())


def _summed(keys: list[np.ndarray], n: np.ndarray) -> list[np.ndarray]:
    """The distinct rows of ``keys`` in order and the sums of ``n``."""
    order = np.lexsort(keys[::-1])
    keys, n = [k[order] for k in keys], n[order]
    new = np.ones(len(n), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return [*(k[first] for k in keys), np.add.reduceat(n, first) if len(n) else n]


def _fields(df: DataFrame, keys: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*keys).schema)


def gram_counts(df: DataFrame, keys: list[str], text: str, but: np.ndarray | None = None) -> DataFrame:
    """(keys, gram, n): trigram counts built inside each row, without the grams whose sorted codes are ``but``."""
    known = df.sparkSession.sparkContext.broadcast(np.zeros(0, np.int64) if but is None else but)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, code, row in _coded(batch):
                row, code, n = _summed([row, code], np.ones(len(code), np.int64))
                if len(known.value):
                    other = np.flatnonzero(known.value[np.minimum(np.searchsorted(known.value, code), len(known.value) - 1)] != code)
                    row, code, n = row[other], code[other], n[other]
                own = rows.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*own.columns[:-1], _grams(code), pa.array(n)], [*keys, "gram", "n"])

    return _spaced(df, keys, text).mapInArrow(run, _fields(df, keys) + "gram string, n long")


def label_grams(docs: DataFrame, label: str, text: str) -> DataFrame:
    """(label, gram, n): trigram counts of all texts of a label, counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # counts by label; there is a handful of them
        held: dict = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, (code, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(code), kind), _grams(code), pa.array(n)], [label, "gram", "n"])
            held.clear()

        for batch in batches:
            kind = batch.schema.field(0).type
            for rows, code, row in _coded(batch):
                names = rows.column(0).dictionary_encode(null_encoding="encode")
                which = names.indices.to_numpy(zero_copy_only=False)[row]
                for i, name in enumerate(names.dictionary.to_pylist()):
                    found, n = np.unique(code[which == i], return_counts=True)
                    if not len(found):
                        continue
                    if name in held:
                        found, n = _summed([np.concatenate([held[name][0], found])], np.concatenate([held[name][1], n]))
                    held[name] = found, n
                if sum(len(c) for c, _ in held.values()) > FLUSH_GRAMS:
                    yield from out()
        yield from out()

    counts = _spaced(docs, [label], text).mapInArrow(run, _fields(docs, [label]) + "gram string, n long")
    return counts.groupBy(label, "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, label: str, text: str) -> DataFrame:
    """Model with one row per gram: ``gram, per_label`` where ``per_label`` is
    an array of (label, prior, log_p).

    Every gram is kept.  Smoothing is add-one.
    """
    # Read four times below; far smaller than the texts.
    per_label = materialize(label_grams(docs, label, text), "gram-counts")
    vocabulary = per_label.agg(F.count_distinct("gram")).scalar()
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    priors = docs.groupBy(label).agg(F.log(F.count(F.lit(1)) / n_docs).alias("prior"))
    totals = per_label.groupBy(label).agg(F.sum("n").alias("total"))
    # One struct per label: a handful of languages.
    labels = priors.join(totals, label).agg(
        F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), "prior", "total"))).alias("l")
    ).scalar()
    counts = per_label.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("__m"))
    per = F.transform(
        F.col("__labels"),
        lambda x: F.struct(
            x["label"].alias("label"),
            x["prior"].alias("prior"),
            F.log(
                (F.coalesce(F.try_element_at("__m", x["label"]), F.lit(0)) + 1.0) / (x["total"] + F.col("__v"))
            ).alias("log_p"),
        ),
    )
    return counts.withColumns({"__labels": labels, "__v": vocabulary}).select("gram", per.alias("per_label"))


def _log_sums(chunked: DataFrame, keys: list[str], text: str, model: DataFrame, n_labels: int) -> DataFrame:
    """(keys, hits, s0, s1, ...): per chunk the grams that the model has and the sums of their logs by label."""
    logs = [F.get("per_label", F.lit(i))["log_p"] for i in range(n_labels)]
    flat = materialize(model.select("gram", *[x.alias(f"__l{i}") for i, x in enumerate(logs)]), "gram-logs")
    whole = flat.count() <= HELD_GRAMS
    # the likeliest grams first: most texts need few others
    held = flat if whole else flat.orderBy(F.desc(F.greatest("__l0", *flat.columns[1:])), "gram").limit(HELD_GRAMS)
    found = held.toArrow()
    three = np.frombuffer("".join(found["gram"].to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64).reshape(-1, 3)
    codes = (three[:, 0] << 42) | (three[:, 1] << 21) | three[:, 2]
    order = np.argsort(codes)
    codes = codes[order]
    sent = chunked.sparkSession.sparkContext.broadcast((codes, [found[f"__l{i}"].to_numpy()[order] for i in range(n_labels)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, logs = sent.value
        for batch in batches:
            for rows, code, row in _coded(batch):
                n = rows.num_rows
                own, back = np.unique(code, return_inverse=True)
                place = np.minimum(np.searchsorted(codes, own), max(len(codes) - 1, 0))
                hit = codes[place] == own if len(codes) else np.zeros(len(own), bool)
                cols = [pa.array(np.bincount(row, hit[back], n).astype(np.int64))]
                cols += [pa.array(np.bincount(row, np.where(hit, x[place], 0.0)[back] if len(codes) else np.zeros(len(row)), n).astype(float)) for x in logs]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *cols], [*keys, "hits", *(f"s{i}" for i in range(n_labels))])

    names = [f"s{i}" for i in range(n_labels)]
    schema = _fields(chunked, keys) + "hits long" + "".join(f", {x} double" for x in names)
    sums = materialize(_spaced(chunked, keys, text).mapInArrow(run, schema), "gram-sums")
    if whole:
        return sums
    rest = gram_counts(chunked, keys, text, codes).join(flat.join(held.select("gram"), "gram", "left_anti"), "gram")
    more = rest.groupBy(*keys).agg(F.sum("n").alias("hits"), *[F.sum(F.col("n") * F.col(f"__l{i}")).alias(x) for i, x in enumerate(names)])
    return sums.withColumn("__chunk", F.lit(True)).unionByName(more.withColumn("__chunk", F.lit(False)))


def predict(chunked: DataFrame, keys: list[str], text: str, model: DataFrame) -> DataFrame:
    """Best label and its posterior per chunk; ``??`` where no word holds a
    letter.

    Tasks hold the ``HELD_GRAMS`` likeliest grams of the model and sum over a chunk's grams
    where the text is; grams beyond them meet the model by a join.
    """
    # labels and priors are the same in every row of the model; there is a handful of them
    first = model.select("per_label").first()
    labels = [(x["label"], x["prior"]) for x in first["per_label"]] if first else [("??", 0.0)]
    found = _log_sums(chunked, keys, text, model, len(labels))
    each = found.where("__chunk") if "__chunk" in found.columns else found
    summed = found.where("hits > 0").groupBy(*keys).agg(*[F.sum(f"s{i}").alias(f"__s{i}") for i in range(len(labels))])
    scores = F.array(*[F.struct((F.col(f"__s{i}") + prior).alias("s"), F.lit(label).alias("label")) for i, (label, prior) in enumerate(labels)])
    best = summed.select(*keys, scores.alias("__all")).withColumn("__top", F.array_max(F.transform("__all", lambda x: x["s"])))
    total = F.aggregate("__all", F.lit(0.0), lambda acc, x: acc + F.exp(x["s"] - F.col("__top")))
    winner = F.array_min(F.transform(F.filter("__all", lambda x: x["s"] == F.col("__top")), lambda x: x["label"]))
    out = best.select(*keys, winner.alias("predicted"), (F.lit(1.0) / total).alias("confidence"))
    return (
        each.select(*keys).join(out, keys, "left")
        .withColumns({
            "predicted": F.coalesce("predicted", F.lit("??")),
            "confidence": F.coalesce("confidence", F.lit(0.0)),
        })
    )


def predict_with(
    chunked: DataFrame, keys: list[str], text: str, score: Callable[[pd.Series], pd.DataFrame]
) -> DataFrame:
    """Predictions of a user's model: ``score`` maps a batch of texts to a frame
    with ``predicted`` and ``confidence``."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunked.select(*keys).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = score(batch[text])
            yield batch[keys].assign(predicted=found["predicted"].values, confidence=found["confidence"].values)

    return chunked.select(*keys, text).mapInPandas(run, schema + ", predicted string, confidence double")


def settled(language: Column, confidence: Column, minimum: float = MIN_CONFIDENCE) -> Column:
    """A non-English guess below the confidence floor counts as English."""
    return F.when((language != "en") & (language != "??") & (confidence < minimum), F.lit("en")).otherwise(language)


def file_profiles(docs: DataFrame, predictions: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Languages per file, chunk count, and whether it is mainly English."""
    lang = settled(F.col("predicted"), F.col("confidence"))
    found = predictions.withColumn("__l", lang).groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set("__l")), ",").alias("languages"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.avg(F.col("__l").isin("en", "??").cast("double")).alias("__share"),
    )
    return docs.select(*keys, F.size(words(F.col(text))).cast("long").alias("word_count")).join(found, keys, "left").select(
        *keys,
        "word_count",
        F.coalesce("languages", F.lit("no_content")).alias("languages"),
        F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"),
        (F.coalesce("__share", F.lit(1.0)) >= ENGLISH_SHARE).alias("english_only"),
    )


def file_rows(profiles: DataFrame, keys: list[str]) -> DataFrame:
    """A row per file in the section of all files, and a second one for those that are not English."""
    sections = F.explode(F.when(F.col("english_only"), F.array(F.lit("all files"))).otherwise(F.array(F.lit("all files"), F.lit("not English"))))
    return profiles.select(*keys, sections.alias("section"), "languages", "word_count")


def channel_report(profiles: DataFrame, channel: str) -> DataFrame:
    """Files, English files and language sets per channel."""
    return profiles.groupBy(channel).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(F.col("english_only")).alias("n_english"),
        F.sum("word_count").alias("n_words"),
        F.array_join(F.array_sort(F.collect_set("languages")), "; ").alias("profiles"),
    )
