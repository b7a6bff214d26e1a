"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import hold
from ..session import Scratch
from .common import first_by_hash, fold, id_and_text

#: Labelled rows that the trees and the weights are fitted on at most, the first by hash of their id.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE = 40, 3, 24, 0.3
PENALTIES = (0.01, 0.003, 0.001)
STEPS = 150


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with ``doc_id`` and one double per statistic of the whole text; an empty text has zeros."""
    d = id_and_text(docs, id_col, text_col)
    d = hold(d, ws=F.array_remove(F.split("text", r"\s+"), ""), lines=F.array_remove(F.split("text", "\n"), ""))
    d = hold(d, n=F.length("text").cast("double"), n_ws=F.size("ws").cast("double"), n_lines=F.size("lines").cast("double"), lead=F.array_distinct("lines"), distinct=F.size(F.array_distinct("ws")).cast("double"))

    def count(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern)).cast("double")

    def has(chars: str) -> Column:
        return F.length("text").cast("double") - F.length(F.replace("text", F.lit(chars), F.lit("")))

    def per(a: Column, b: str) -> Column:
        return F.coalesce(F.try_divide(a, F.col(b)), F.lit(0.0))

    made = {
        "log_chars": F.log1p("n"),
        "log_words": F.log1p("n_ws"),
        "log_lines": F.log1p("n_lines"),
        "word_length": per(F.col("n"), "n_ws"),
        "words_per_line": per(F.col("n_ws"), "n_lines"),
        "distinct_words": per(F.col("distinct"), "n_ws"),
        "distinct_lines": per(F.size("lead").cast("double"), "n_lines"),
        "pipes": per(has("|"), "n_ws"),
        "bangs": per(has("!"), "n_ws"),
        "hashes": per(has("#"), "n_ws"),
        "dots": per(has("."), "n_ws"),
        "commas": per(has(","), "n_ws"),
        "stars": per(has("*"), "n_ws"),
        "braces": per(has("{") + has("<"), "n_ws"),
        "symbols": per(count(r"[#$%&*@^~=+|\\/<>{}\[\]_]"), "n"),
        "digits": per(count(r"[0-9]"), "n"),
        "capitals": per(count(r"\p{Lu}"), "n"),
        "capital_words": per(count(r"(?<![\p{L}])\p{Lu}{2,}"), "n_ws"),
        "short_words": per(count(r"(?<!\S)\S{1,3}(?!\S)"), "n_ws"),
        "long_words": per(count(r"\S{13,}"), "n_ws"),
        "last_dot": F.col("text").rlike(r"[.!?]\s*\z").cast("double"),
    }
    out = hold(d, **made)
    return out.select("doc_id", *made)


def _grow(x: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, rows: np.ndarray, path: tuple, depth: int, rules: list, leaf: np.ndarray, rng) -> None:
    """Least-squares tree of binned statistics on ``rows``; every path below the root becomes a rule."""
    g = grad[rows]
    if depth == 0 or len(rows) < 20:
        leaf[rows] = g.mean() if len(rows) else 0.0
        return
    best = (1e-9, -1, -1)
    for f in range(x.shape[1]):
        n = np.bincount(x[rows, f], minlength=BINS)[:-1].cumsum()
        s = np.bincount(x[rows, f], g, BINS)[:-1].cumsum()
        ok = (n >= 10) & (len(rows) - n >= 10)
        gain = np.where(ok, s**2 / np.maximum(n, 1) + (g.sum() - s) ** 2 / np.maximum(len(rows) - n, 1), 0) - g.sum() ** 2 / len(rows)
        b = int(gain.argmax())
        if ok[b] and b < len(edges[f]) and gain[b] > best[0]:
            best = (float(gain[b]), f, b)
    if best[1] < 0:
        leaf[rows] = g.mean()
        return
    _, f, b = best
    low = x[rows, f] <= b
    for side, part in ((True, rows[low]), (False, rows[~low])):
        longer = (*path, (f, side, float(edges[f][b])))
        rules.append(longer)
        _grow(x, edges, grad, part, longer, depth - 1, rules, leaf, rng)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def tree_rules(stats: np.ndarray, y: np.ndarray, seed: int = 7) -> list[tuple]:
    """Distinct conjunctions (statistic, at most / more than, threshold) along the paths of boosted trees."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(stats[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(stats.shape[1])]
    x = np.stack([np.searchsorted(e, stats[:, f], side="left") for f, e in enumerate(edges)], 1)
    z, rules = np.zeros(len(y)), []
    for _ in range(TREES):
        rows = np.sort(rng.choice(len(y), max(1, len(y) // 2), replace=False))
        grad, leaf, own = y - _sigmoid(z), np.zeros(len(y)), []
        _grow(x, edges, grad, rows, (), DEPTH, own, leaf, rng)
        # rows outside the half get the value of their path
        for r in sorted(own, key=len):
            inside = _holds(stats, r)
            used = np.zeros(len(y), bool)
            used[rows] = True
            if (inside & used).any():
                leaf[inside & ~used] = leaf[inside & used].mean()
        z += RATE * 4 * leaf
        rules += own
    return list(dict.fromkeys(rules))


def _holds(stats: np.ndarray, rule: tuple) -> np.ndarray:
    out = np.ones(len(stats), bool)
    for f, at_most, edge in rule:
        out &= (stats[:, f] <= edge) == at_most
    return out


def lasso(a: np.ndarray, y: np.ndarray, penalty: float, w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty by accelerated proximal gradient, from a start."""
    n = len(y)
    # largest eigenvalue of a'a/n by power iteration bounds the step
    v = np.ones(a.shape[1]) / np.sqrt(a.shape[1])
    for _ in range(12):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v) + 1e-12
    step = 4 / ((np.linalg.norm(a @ v) ** 2) / n + 1.0)
    at, bt, t = w.copy(), b, 1.0
    for _ in range(STEPS):
        r = _sigmoid(a @ at + bt) - y
        nw = at - step * (a.T @ r / n)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nb = bt - step * float(r.mean())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at, bt = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


def fit(stats: np.ndarray, y: np.ndarray) -> tuple[list[tuple[tuple, float]], float]:
    """Rules with non-zero weights and the intercept; the penalty is the best of ``PENALTIES`` on a fifth of the rows."""
    if len(y) == 0:
        return [], 0.0
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(prior / (1 - prior)))
    if y.min() == y.max():
        return [], base
    rules = tree_rules(stats, y)
    if not rules:
        return [], base
    a = np.stack([_holds(stats, r) for r in rules], 1).astype(np.float32)
    _, first = np.unique(np.packbits(a > 0, axis=0), axis=1, return_index=True)
    first = np.sort(first)
    rules, a = [rules[i] for i in first], a[:, first]
    check = np.arange(len(y)) % 5 == 0

    def loss(w, b):
        p = np.clip(_sigmoid(a[check] @ w + b), 1e-6, 1 - 1e-6)
        return -float(np.mean(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p)))

    w, b, best = np.zeros(a.shape[1]), base, (np.inf, PENALTIES[0])
    for penalty in PENALTIES:
        w, b = lasso(a[~check], y[~check], penalty, w, b)
        best = min(best, (loss(w, b), penalty))
    w, b = lasso(a, y, best[1], w, b)
    return [(r, float(x)) for r, x in zip(rules, w) if x != 0], float(b)


def compiled(rules: list[tuple[tuple, float]], intercept: float, names: list[str]) -> Column:
    """The ensemble as one column expression: probability of label 1."""
    z = F.lit(intercept)
    for rule, weight in rules:
        holds = F.lit(True)
        for f, at_most, edge in rule:
            holds = holds & ((F.col(names[f]) <= edge) if at_most else (F.col(names[f]) > edge))
        z = z + F.when(holds, F.lit(weight)).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", folds: int = 3, held_fold: int = 1, sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    Only labels outside ``held_fold`` are learned from, at most ``sample`` of them (the
    first by hash of the id); statistics are of whole texts, and of all documents.  Null
    labels and ids do not train; of repeated labels the largest counts.  Null texts count
    as empty and get a score like any other; without usable labels every score is 0.5; an
    empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.save(statistics(docs, id_col, text_col).withColumn("held_out", fold(F.col("doc_id"), folds) == held_fold), "statistics")
    names = [c for c in stats.columns if c not in ("doc_id", "held_out")]
    known = labels.select(F.col(label_id).alias("doc_id"), F.col(label_col).cast("double").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    train = stats.where(~F.col("held_out")).join(known, "doc_id")
    rows = first_by_hash(train, "doc_id", sample).select(*names, "label").toPandas()
    model = fit(rows[names].to_numpy("float64"), rows["label"].to_numpy("float64"))
    score = compiled(*model, names)
    return stats.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
