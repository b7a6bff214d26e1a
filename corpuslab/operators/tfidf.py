"""TF-IDF over words and phrases, one sparse vector a row.

Texts are tokenised once: a document's terms and their counts are arrays of its
row (sort, then run lengths), which are stored.  The vocabulary is the top
``cap`` features, at most ``cap`` rows per group; it is looked up inside the
rows, where all terms of a document are together, so weights and norms need no
exchange and neither texts nor postings move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import run_starts
from ..session import materialize
from .topn import top_per_group

TOKEN = r"[\p{L}\p{N}_]{2,}"
MAX_FEATURES = 10000
#: Vocabulary rows of all groups that are looked up together; more groups are taken one set after the other.
ENTRIES = 2_000_000
#: Terms of documents that a task looks up together, or four times the vocabulary if that is more.
READ_TERMS = 1 << 17
SCORE_DECIMALS = 6

# English function words removed before phrases are formed.  A
# default only; pass ``stop_words`` to use another list.
STOP_WORDS = [
    "about", "above", "after", "again", "against", "all", "also", "am", "an", "and", "any", "are", "as", "at", "be",
    "because", "been", "before", "being", "below", "between", "both", "but", "by", "can", "cannot", "could", "did",
    "do", "does", "doing", "down", "during", "each", "few", "for", "from", "further", "had", "has", "have",
    "having", "he", "her", "here", "hers", "herself", "him", "himself", "his", "how", "if", "in", "into", "is",
    "it", "its", "itself", "just", "me", "more", "most", "must", "my", "myself", "no", "nor", "not", "now", "of",
    "off", "on", "once", "only", "or", "other", "our", "ours", "ourselves", "out", "over", "own", "same", "she",
    "should", "so", "some", "such", "than", "that", "the", "their", "theirs", "them", "themselves", "then", "there",
    "these", "they", "this", "those", "through", "to", "too", "under", "until", "up", "us", "very", "was", "we",
    "were", "what", "when", "where", "which", "while", "who", "whom", "why", "will", "with", "would", "you", "your",
    "yours", "yourself", "yourselves",
]


def _kept_tokens(text: Column, stop_words: list[str]) -> Column:
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return F.filter(tokens, lambda t: ~t.isin(*stop_words)) if stop_words else tokens


def _ngrams(kept: Column, n: int) -> Column:
    if n == 1:
        return kept
    grams = F.transform(
        F.sequence(F.lit(0), F.size(kept) - n), lambda i: F.concat_ws(" ", *[kept[i + j] for j in range(n)])
    )
    return F.when(F.size(kept) >= n, grams).otherwise(F.array().cast("array<string>"))


def vectors(docs: DataFrame, text: str, ngrams: tuple[int, int] = (1, 2), stop_words: list[str] | None = None) -> DataFrame:
    """``docs`` with ``terms``, the document's distinct terms in order, and their counts ``tfs`` in place of the text."""
    stop = STOP_WORDS if stop_words is None else stop_words
    keep = [c for c in docs.columns if c != text]
    kept = docs.select(*keep, _kept_tokens(F.col(text), list(stop)).alias("__kept"))
    grams = [_ngrams(F.col("__kept"), n) for n in range(ngrams[0], ngrams[1] + 1)]
    sorted_terms = kept.select(*keep, F.sort_array(F.concat(*grams)).alias("__terms"))
    t, starts = F.col("__terms"), F.col("__starts")
    found = sorted_terms.select(*keep, "__terms", F.coalesce(run_starts(t), F.array().cast("array<int>")).alias("__starts"))
    tfs = F.transform(starts, lambda a, i: (F.coalesce(F.get(starts, i + 1), F.size(t)) - a).cast("long"))
    return found.select(*keep, F.transform(starts, lambda a: t[a]).alias("terms"), tfs.alias("tfs"))


def postings(found: DataFrame) -> DataFrame:
    """One row per (document row, term) with ``tf``; other columns are kept."""
    keep = [c for c in found.columns if c not in ("terms", "tfs")]
    rows = found.select(*keep, F.explode(F.arrays_zip("terms", "tfs")).alias("__e"))
    return rows.select(*keep, F.col("__e.terms").alias("term"), F.col("__e.tfs").alias("tf"))


def term_counts(
    docs: DataFrame, text: str, ngrams: tuple[int, int] = (1, 2), stop_words: list[str] | None = None
) -> DataFrame:
    """One row per (document row, term) with ``tf``; other columns are kept."""
    return postings(vectors(docs, text, ngrams, stop_words))


def vocabulary(counts: DataFrame, group: list[str], cap: int = MAX_FEATURES) -> DataFrame:
    """The ``cap`` most frequent terms (per group): ``term, cf, df``; ties by
    term ascending."""
    totals = counts.groupBy(*group, "term").agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
    order = [F.desc("cf"), F.asc("term")]
    if not group:
        return totals.orderBy(*order).limit(cap)
    return top_per_group(totals, group, order, cap, spread_on="term")


def slices(batch: pa.RecordBatch, lists: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose lists in column ``lists`` have about ``limit`` items together."""
    total = np.cumsum(batch.column(lists).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    cuts = np.flatnonzero(np.diff(total // limit, append=-1)) + 1
    for start, stop in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
        yield batch.slice(start, stop - start)


def _looked_up(found: DataFrame, group: str | None, vocab: DataFrame) -> DataFrame:
    """``found`` with ``hits``, the (entry, tf, weight) of its terms that are in ``vocab`` (group, term, df, n_docs, entry).

    ``vocab`` has ``ENTRIES`` rows at most and is held by every task; the row's
    terms are looked up together and its norm is a sum over the row.
    """
    table = vocab.toArrow()
    names = table["group"].combine_chunks().dictionary_encode()
    terms = table["term"].combine_chunks().dictionary_encode()
    code = names.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(terms.dictionary) + terms.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code)
    idf = np.log((1.0 + table["n_docs"].to_numpy()) / (1.0 + table["df"].to_numpy())) + 1.0
    sent = found.sparkSession.sparkContext.broadcast((names.dictionary, terms.dictionary, code[order], table["entry"].to_numpy()[order], idf[order]))
    keep = [c for c in found.columns if c not in ("terms", "tfs")]
    at = {c: found.columns.index(c) for c in found.columns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, terms, codes, entry, idf = sent.value
        for batch in (part for whole in batches for part in slices(whole, at["terms"], max(READ_TERMS, 4 * len(terms)))):
            own, counts = batch.column(at["terms"]), batch.column(at["tfs"])
            sizes = own.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            which = np.zeros(len(sizes), np.int64)
            if group is not None:
                which = pc.fill_null(pc.index_in(batch.column(at[group]).cast(names.type), value_set=names), -1).to_numpy(zero_copy_only=False)
            term = pc.fill_null(pc.index_in(own.flatten(), value_set=terms), -1).to_numpy(zero_copy_only=False)
            wanted = which[row] * len(terms) + term
            place = np.minimum(np.searchsorted(codes, wanted), max(len(codes) - 1, 0))
            hit = np.flatnonzero((term >= 0) & (which[row] >= 0) & (codes[place] == wanted)) if len(codes) else np.zeros(0, np.int64)
            tf = counts.flatten().to_numpy(zero_copy_only=False)[hit]
            raw = tf * idf[place[hit]]
            norm = np.sqrt(np.bincount(row[hit], raw * raw, len(sizes)))
            entries = pa.StructArray.from_arrays([pa.array(entry[place[hit]]), pa.array(tf), pa.array(raw / norm[row[hit]])], ["entry", "tf", "weight"])
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[hit], minlength=len(sizes)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(at[c]) for c in keep), pa.ListArray.from_arrays(pa.array(ends), entries)], [*keep, "hits"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields if f.name in keep)
    return found.mapInArrow(run, f"{schema}, hits array<struct<entry:long,tf:long,weight:double>>")


def weights(
    docs: DataFrame,
    doc: str,
    text: str,
    group: list[str] | None = None,
    ngrams: tuple[int, int] = (1, 2),
    cap: int = MAX_FEATURES,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """L2-normed TF-IDF weight per (document, vocabulary term).

    idf = ln((1 + N) / (1 + df)) + 1 with N and df local to the group (one column
    at most; rows of a null group are left out).  Adds ``term, tf, df, n_docs,
    weight``.  Every row is a document of its own.
    """
    group = group or []
    if len(group) > 1:
        raise ValueError("one group column at most")
    found = materialize(vectors(docs, text, ngrams, stop_words), "term-vectors")
    vocab = vocabulary(postings(found.select(*group, "terms", "tfs")), group, cap)
    if group:
        vocab = vocab.join(found.groupBy(*group).agg(F.count(F.lit(1)).alias("n_docs")), group)
    else:
        vocab = vocab.withColumn("n_docs", F.lit(found.count()))
    name = F.col(group[0]).cast("string") if group else F.lit("")
    vocab = materialize(vocab.select(name.alias("group"), "term", "df", "n_docs").withColumn("entry", F.monotonically_increasing_id()), "vocabulary")
    out = None
    # a group is a period or a channel; their names are few next to the vocabulary
    names = sorted(r["group"] for r in vocab.select("group").distinct().collect())
    step = max(1, ENTRIES // cap)
    for i in range(0, max(1, len(names)), step):
        some = names[i : i + step]
        rows = found.where(name.isin(some)) if group and len(names) > step else found
        part = vocab.where(F.col("group").isin(some)) if group and len(names) > step else vocab
        hits = _looked_up(rows, group[0] if group else None, part)
        keep = [c for c in hits.columns if c != "hits"]
        flat = hits.select(*keep, F.explode("hits").alias("__h")).select(*keep, "__h.entry", "__h.tf", "__h.weight")
        made = flat.join(F.broadcast(part.select("entry", "term", "df", "n_docs")), "entry").drop("entry")
        out = made if out is None else out.unionByName(made)
    return out


def entries(weighted: DataFrame, group: list[str] | None = None, channel: str = "channel") -> DataFrame:
    """Term statistics: mean weight over all documents, document frequency,
    sorted distinct channels."""
    group = group or []
    return weighted.groupBy(*group, "term").agg(
        F.round(F.sum("weight") / F.first("n_docs"), SCORE_DECIMALS).alias("score"),
        F.count(F.lit(1)).alias("document_frequency"),
        F.array_sort(F.collect_set(channel)).alias("channels"),
    )


def is_phrase(term: str = "term") -> Column:
    return F.contains(F.col(term), F.lit(" "))



def top_terms(found: DataFrame, n: int) -> DataFrame:
    """Single words by score, then term."""
    return found.where(~is_phrase()).orderBy(F.desc("score"), F.asc("term")).limit(n)


def top_phrases(found: DataFrame, n: int, min_documents: int) -> DataFrame:
    """Phrases in enough documents, by document frequency, score, term."""
    return (
        found.where(is_phrase() & (F.col("document_frequency") >= min_documents))
        .orderBy(F.desc("document_frequency"), F.desc("score"), F.asc("term"))
        .limit(n)
    )


def top_documents(weighted: DataFrame, terms: DataFrame, doc: str, title: str, cap: int) -> DataFrame:
    """The heaviest documents of each reported term.

    ``terms`` is a capped report (tens of rows), so it may be broadcast; the
    group limit prunes a common term map-side.
    """
    hits = weighted.join(F.broadcast(terms.select("term")), "term")
    rounded = hits.withColumn("weight", F.round("weight", 9))
    order = [F.desc("weight"), F.asc("channel"), F.asc(doc), F.asc(title)]
    return top_per_group(rounded, ["term"], order, cap, spread_on=doc, rank="position")
