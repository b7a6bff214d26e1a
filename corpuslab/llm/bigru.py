"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import first_by_hash, fold, groups, id_and_text, words_of

#: Labelled rows of each label that are learned from at most, the first by hash of their id.
SAMPLE = 1500
#: Words of a window, and from one window to the next: neighbours overlap.
WINDOW, STEP = 32, 24
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8
#: Words of the training texts with a vector of their own at most; n-gram vectors are hashed.
VOCABULARY = 30_000
NGRAM_BITS = 15
NGRAMS = (3, 4, 5, 6)
EPOCHS, BATCH, LEARNING_RATE = 8, 128, 0.01
#: Word types whose gate inputs a task keeps, in a table of this size (19 MB); it is emptied when full and when the task ends.
MEMO_WORDS = 100_000
#: Word types whose n-grams are looked at together in training.
TYPES = 20_000
EDGES = b".,!?;:|%*#$&\"'()[]{}<>-_=+/\\~`^@"


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of all hashed byte n-grams of ``<word>``, by word."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint32)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    who, what = [], []
    for n in NGRAMS:
        h = np.full(max(0, len(data) - n + 1), n, np.uint32)
        for j in range(n):
            h = h * np.uint32(1_000_003) ^ data[j : j + len(h)]
        h = (h * np.uint32(2_654_435_761)) >> np.uint32(32 - NGRAM_BITS)
        ok = left[: len(h)] >= n
        who.append(owner[: len(h)][ok])
        what.append(h[ok].astype(np.int64))
    who, what = np.concatenate(who), np.concatenate(what)
    order = np.argsort(who, kind="stable")
    return who[order], what[order]


def windows(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(document index, word ids padded with -1) of all overlapping windows; a text without words has one empty window."""
    doc, out = [], []
    for i, own in enumerate(ids):
        n = max(1, -(-(len(own) - WINDOW + STEP) // STEP)) if len(own) else 1
        padded = np.full((n - 1) * STEP + WINDOW, -1, np.int64)
        padded[: len(own)] = own[: len(padded)]
        out.append(padded[np.arange(n)[:, None] * STEP + np.arange(WINDOW)])
        doc.append(np.full(n, i))
    return np.concatenate(doc), np.concatenate(out)


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters, word table and static log-odds of one trained model."""

    def __init__(self, vocabulary: dict[bytes, int], word_odds: np.ndarray, gram_odds: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM + 1, HIDDEN

        def mat(*shape, scale=0.3):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.vocabulary, self.gram_odds = vocabulary, gram_odds.astype(np.float32)
        self.p = {
            "word": mat(len(vocabulary) + 1, WORD_DIM, scale=0.05), "gram": mat(1 << NGRAM_BITS, CHAR_DIM, scale=0.05),
            "wf": mat(d, 3 * h), "bf": np.zeros(3 * h, np.float32), "uf": mat(h, 3 * h), "wb": mat(d, 3 * h), "bb": np.zeros(3 * h, np.float32), "ub": mat(h, 3 * h),
            "a": mat(2 * h, ATTENTION), "c": np.zeros(ATTENTION, np.float32), "v": mat(ATTENTION), "o": mat(2 * h), "b": np.zeros(1, np.float32),
        }
        self.p["word"][:, 0] = word_odds
        self.p["gram"][:, 0] = gram_odds
        self.scale = (1.0, 0.0, 0.0)
        self.reset()

    def reset(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.gates = np.zeros((0, 6 * HIDDEN), np.float32)

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word place, n-gram owner, n-gram bucket, input vectors) of word types, without the punctuation at their edges."""
        words = [w.strip(EDGES) for w in words]
        place = np.array([self.vocabulary.get(w, len(self.vocabulary)) for w in words], np.int64)
        owner, bucket = ngrams(words)
        n = np.maximum(np.bincount(owner, minlength=len(words)), 1)[:, None]
        starts = np.searchsorted(owner, np.arange(len(words)))
        # words of punctuation alone have no n-gram: a zero row at the end takes their place
        has = np.bincount(owner, minlength=len(words))[:, None] > 0
        char = np.where(has, np.add.reduceat(np.concatenate([self.p["gram"][bucket], np.zeros((1, CHAR_DIM), np.float32)]), starts) / n, 0)
        peak = np.where(has[:, 0], np.maximum.reduceat(np.append(self.gram_odds[bucket], np.float32(0)), starts), 0)
        return place, owner, bucket, np.concatenate([self.p["word"][place], char, peak[:, None]], 1).astype(np.float32)

    def ids(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Rows of the gate table for all words; new word types are computed together."""
        kinds = {w for t in texts for w in t}
        new = [w for w in kinds if w not in self.rows]
        if len(self.rows) + len(new) > len(self.gates):
            # the table is there once; only texts with more word types than that make it larger
            self.rows, new = {}, list(kinds)
            if max(MEMO_WORDS, len(new)) != len(self.gates):
                self.gates = np.zeros((max(MEMO_WORDS, len(new)), 6 * HIDDEN), np.float32)
        rows = self.rows
        if new:
            x = self.inputs(new)[3]
            made = np.concatenate([x @ self.p["wf"] + self.p["bf"], x @ self.p["wb"] + self.p["bb"]], 1)
            start, stop = len(rows), len(rows) + len(new)
            self.gates[start:stop] = made
            rows.update(zip(new, range(start, stop)))
        return [np.fromiter(map(rows.__getitem__, t), np.int64, len(t)) for t in texts]

    def _direction(self, gates: np.ndarray, mask: np.ndarray, u: np.ndarray, order, keep: list | None):
        h = np.zeros((len(mask), HIDDEN), np.float32)
        out = np.empty((len(mask), WINDOW, HIDDEN), np.float32)
        k = HIDDEN
        for t in order:
            g, a = gates[:, t], h @ u
            zr = _sigmoid(g[:, : 2 * k] + a[:, : 2 * k])
            z, r = zr[:, :k], zr[:, k:]
            n = np.tanh(g[:, 2 * k :] + r * a[:, 2 * k :])
            new = n + z * (h - n)
            if keep is not None:
                keep.append((t, h, z, r, n, a[:, 2 * k :]))
            h = new if mask[:, t].all() else np.where(mask[:, t, None], new, h)
            out[:, t] = h
        return out

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window from its gate inputs (windows, words, both directions)."""
        p = self.p
        fk, bk = ([], []) if keep is not None else (None, None)
        k = 3 * HIDDEN
        hs = np.concatenate([self._direction(gates[:, :, :k], mask, p["uf"], range(WINDOW), fk), self._direction(gates[:, :, k:], mask, p["ub"], range(WINDOW - 1, -1, -1), bk)], 2)
        e = np.tanh(hs @ p["a"] + p["c"])
        s = np.where(mask, e @ p["v"], -1e9)
        s = np.exp(s - s.max(1, keepdims=True)) * mask
        alpha = s / np.maximum(s.sum(1, keepdims=True), 1e-9)
        pooled = (alpha[:, :, None] * hs).sum(1)
        if keep is not None:
            keep |= {"f": fk, "b": bk, "hs": hs, "e": e, "alpha": alpha, "pooled": pooled}
        return pooled @ p["o"] + p["b"][0]

    def logits(self, wins: np.ndarray, block: int = 1024) -> np.ndarray:
        out = np.empty(len(wins), np.float32)
        for i in range(0, len(wins), block):
            w = wins[i : i + block]
            out[i : i + block] = self.forward(self.gates[np.maximum(w, 0)], w >= 0)
        return out

    def backward(self, dlogit: np.ndarray, mask: np.ndarray, keep: dict, x: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters and of the inputs ``x`` (windows, words, inputs)."""
        p, g = self.p, {}
        g["o"], g["b"] = keep["pooled"].T @ dlogit, np.array([dlogit.sum()])
        dp = dlogit[:, None] * p["o"]
        hs, e, alpha = keep["hs"], keep["e"], keep["alpha"]
        dh = alpha[:, :, None] * dp[:, None, :]
        da = (hs * dp[:, None, :]).sum(2)
        ds = alpha * (da - (alpha * da).sum(1, keepdims=True))
        g["v"] = (e * ds[:, :, None]).sum((0, 1))
        de = ds[:, :, None] * p["v"] * (1 - e * e)
        g["a"], g["c"] = np.tensordot(hs, de, ((0, 1), (0, 1))), de.sum((0, 1))
        dh = dh + de @ p["a"].T
        dx = 0
        for d, at in (("f", 0), ("b", HIDDEN)):
            u = p["u" + d]
            du, carry = np.zeros_like(u), np.zeros((len(mask), HIDDEN), np.float32)
            dg = np.zeros((len(mask), WINDOW, 3 * HIDDEN), np.float32)
            for t, hp, z, r, n, an in reversed(keep[d]):
                on = mask[:, t, None]
                total = dh[:, t, at : at + HIDDEN] + carry
                d_ = np.where(on, total, 0)
                dn = d_ * (1 - z) * (1 - n * n)
                dz = d_ * (hp - n) * z * (1 - z)
                dr = dn * an * r * (1 - r)
                da_ = np.concatenate([dz, dr, dn * r], 1)
                dg[:, t] = np.concatenate([dz, dr, dn], 1)
                du += hp.T @ da_
                carry = np.where(on, d_ * z + da_ @ u.T, total)
            g["u" + d], g["b" + d] = du, dg.sum((0, 1))
            g["w" + d] = np.tensordot(x, dg, ((0, 1), (0, 1)))
            dx = dx + dg @ p["w" + d].T
        return g, dx

    def document_scores(self, doc: np.ndarray, logit: np.ndarray, n: int) -> np.ndarray:
        """(documents, 2): largest window logit, and mean of the three largest."""
        order = np.lexsort((-logit, doc))
        first = np.searchsorted(doc[order], np.arange(n))
        count = np.bincount(doc, minlength=n)
        top = logit[order]
        out = np.zeros((n, 2))
        out[:, 0] = top[first]
        for k in range(3):
            out[:, 1] += top[first + np.minimum(k, count - 1)] / 3
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        a, b, c = self.scale
        return 1 / (1 + np.exp(-np.clip(a * features[:, 0] + b * features[:, 1] + c, -40, 40)))


def log_odds(present: Iterable[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Smoothed log-odds of label 1 by presence in a text, shrunk and clipped."""
    n = np.zeros((2, size))
    for own, label in zip(present, y):
        n[int(label), own] += 1
    total = np.array([(y == 0).sum(), (y == 1).sum()], float)
    raw = np.log((n[1] + 1) / (total[1] + 2)) - np.log((n[0] + 1) / (total[0] + 2))
    seen = n.sum(0)
    return np.clip(raw * seen / (seen + 5), -3, 3) / 3


def train(texts: list[str], y: np.ndarray, weight: np.ndarray, seed: int = 5) -> Network:
    """Fit on labelled texts.  A text is judged by its highest windows: in each epoch the network picks them anew, and
    learns from the highest window of every text and a random one of the texts of label 0."""
    rng = np.random.default_rng(seed)
    types: dict[bytes, int] = {}
    ids = [np.array([types.setdefault(w.strip(EDGES), len(types)) for w in words_of(t)], np.int32) for t in texts]
    names = list(types)
    own = [np.unique(x) for x in ids]
    df = np.bincount(np.concatenate(own), minlength=len(names)) if own else np.zeros(0, np.int64)
    frequent = sorted((i for i in range(len(names)) if df[i] > 1), key=lambda i: (-df[i], names[i]))[:VOCABULARY]
    vocabulary = {names[i]: k for k, i in enumerate(frequent)}
    place = np.array([vocabulary.get(w, len(vocabulary)) for w in names], np.int64)
    bucket, bounds = grams_of_types(names)
    word_odds = log_odds((np.unique(place[x][place[x] < len(vocabulary)]) for x in own), y, len(vocabulary) + 1)
    gram_odds = log_odds((np.unique(np.concatenate([bucket[bounds[i] : bounds[i + 1]] for i in x] or [bucket[:0]])) for x in own), y, 1 << NGRAM_BITS)
    net = Network(vocabulary, word_odds, gram_odds, seed)
    if not len(y) or y.min(initial=1) == y.max(initial=0):
        prior = np.average(y, weights=weight) if len(y) else 0.5
        net.scale = (0.0, 0.0, float(np.log(np.clip(prior, 1e-3, 0.999) / (1 - np.clip(prior, 1e-3, 0.999)))) if len(y) else 0.0)
        return net
    doc, wins = windows(ids)
    odds = word_odds[place]
    for i in range(0, len(names), TYPES):
        part = bounds[i : i + TYPES + 1]
        peak = np.maximum.reduceat(np.append(gram_odds[bucket[part[0] : part[-1]]], 0), part[:-1] - part[0])
        odds[i : i + TYPES] += np.where(np.diff(part) > 0, peak, 0)
    del bucket, own
    score = np.where(wins >= 0, np.exp(3 * odds)[wins], 0).sum(1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        if epoch > 1:
            score = _type_logits(net, names, wins)
        order = np.lexsort((-score, doc))
        highest = order[np.searchsorted(doc[order], np.arange(len(y)))]
        low = np.flatnonzero(y[doc] == 0)
        picked = np.concatenate([highest, rng.choice(low, min(len(low), int((y == 0).sum())), replace=False)])
        rng.shuffle(picked)
        for i in range(0, len(picked), BATCH):
            own = picked[i : i + BATCH]
            w, label = wins[own], y[doc[own]]
            mask = w >= 0
            kinds, inverse = np.unique(np.maximum(w, 0), return_inverse=True)
            inverse = inverse.reshape(w.shape)
            where, gram_owner, gram_bucket, x = net.inputs([names[k] for k in kinds])
            xs = x[inverse]
            gates = np.concatenate([xs @ net.p["wf"] + net.p["bf"], xs @ net.p["wb"] + net.p["bb"]], 2)
            keep: dict = {}
            logit = net.forward(gates, mask, keep)
            grad, dx = net.backward(((_sigmoid(logit) - label) / len(own)).astype(np.float32), mask, keep, xs)
            dtype = np.zeros_like(x)
            np.add.at(dtype, inverse[mask], dx[mask])
            grad["word"], grad["gram"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["gram"])
            np.add.at(grad["word"], where, dtype[:, :WORD_DIM])
            per = np.maximum(np.bincount(gram_owner, minlength=len(kinds)), 1)[:, None]
            np.add.at(grad["gram"], gram_bucket, (dtype[:, WORD_DIM : WORD_DIM + CHAR_DIM] / per)[gram_owner])
            step += 1
            rate = LEARNING_RATE * (1 - 0.8 * epoch / EPOCHS)
            for k, v in net.p.items():
                m, s = moments[k]
                m += 0.1 * (grad[k] - m)
                s += 0.001 * (grad[k] ** 2 - s)
                v -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    features = net.document_scores(doc, _type_logits(net, names, wins), len(y))
    net.scale = calibrate(features, y, weight)
    net.reset()
    return net


def grams_of_types(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram buckets of all word types, and where those of each begin."""
    buckets, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for i in range(0, len(names), TYPES):
        part = names[i : i + TYPES]
        owner, bucket = ngrams(part)
        buckets.append(bucket.astype(np.int32))
        sizes.append(np.bincount(owner, minlength=len(part)))
    return np.concatenate(buckets), np.cumsum(np.concatenate(sizes))


def _type_logits(net: Network, names: list[bytes], wins: np.ndarray) -> np.ndarray:
    """Logits of windows over word types."""
    net.gates = np.empty((max(1, len(names)), 6 * HIDDEN), np.float32)
    for i in range(0, len(names), TYPES):
        x = net.inputs(names[i : i + TYPES])[3]
        net.gates[i : i + TYPES] = np.concatenate([x @ net.p["wf"] + net.p["bf"], x @ net.p["wb"] + net.p["bb"]], 1)
    out = net.logits(wins)
    net.reset()
    return out


def calibrate(features: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Weighted logistic regression of the label on the two document features, by damped Newton steps."""
    x = np.concatenate([features, np.ones((len(y), 1))], 1)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-2 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + (1e-2 + 1e-3) * np.eye(3)
        move = np.linalg.solve(hess, grad)
        w -= move * min(1.0, 2.0 / (np.abs(move).max() + 1e-9))
    return float(w[0]), float(w[1]), float(w[2])


def fitted(d: DataFrame, labels: DataFrame, label_id: str, label_col: str, folds: int, held_fold: int, sample: int) -> Network:
    """The network learned from (doc_id, text) and their labels outside ``held_fold``."""
    known = labels.select(F.col(label_id).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.where(fold(F.col("doc_id"), folds) != held_fold)
    # ids first, texts for the chosen ones only; twice ``sample`` rows at most
    first = [first_by_hash(known.where(F.col("label") == k), "doc_id", sample) for k in (0, 1)]
    rows = d.join(F.broadcast(first[0].unionByName(first[1])), "doc_id").select("doc_id", "text", "label").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample).collect()
    share = dict(known.groupBy("label").count().collect())
    y = np.array([r["label"] for r in rows], float)
    weight = np.array([share[r["label"]] / (y == r["label"]).sum() for r in rows])
    return train([r["text"] for r in rows], y, weight / weight.mean() if len(weight) else weight)


def scored(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted`` behind them, columns of these names replaced.

    Only the text goes to Python; the other columns wait in the engine.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = model.value
        try:
            for column in batches:
                made = [np.zeros(0)]
                for _, texts in groups(pa.RecordBatch.from_arrays([column], ["text"])):
                    doc, wins = windows(net.ids([words_of(t) for t in texts]))
                    made.append(net.probability(net.document_scores(doc, net.logits(wins), len(texts))))
                yield pa.array(np.concatenate(made))
        finally:
            net.reset()

    rows = docs.select(*keep, F.arrow_udf(run, "double")(text_col).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, columns as they were."""
    net = fitted(id_and_text(docs), labels, "doc_id", "toxic", 5, 0, sample)
    rows = scored(docs.withColumnsRenamed({c: "_" + c for c in ("score", "predicted") if c in docs.columns}), net)
    return rows.where("predicted = 0").drop("score", "predicted").withColumnsRenamed({"_" + c: c for c in ("score", "predicted") if c in docs.columns}).select(docs.columns)


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic", folds: int = 5, held_fold: int = 0, sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    Only labels outside ``held_fold`` are learned from, of each label at most ``sample``
    rows (the first by hash of the id), weighted back to their share.  Every overlapping
    window of every whole text is scored.  Null labels and ids do not train; of repeated
    labels the largest counts.  Null texts count as empty, which are one window without
    words; without usable labels every score is 0.5; an empty table gives no rows.
    """
    d = id_and_text(docs, id_col, text_col).withColumn("held_out", fold(F.col("doc_id"), folds) == held_fold)
    net = fitted(d, labels, label_id, label_col, folds, held_fold, sample)
    return scored(d.select("doc_id", "held_out", "text"), net).drop("text")
