"""Scores of the trained operators, recomputed loop by loop in plain Python from what was fitted."""

import zlib
from collections import Counter
from math import exp, log, log10, log1p, tanh

import numpy as np
import pytest
import regex
import xxhash

from corpuslab.llm import bigru, brown, queries, rules

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n", "a", "Same same.\nSame same.\n\nX!", "ÜBER Été 日本語 #1 | {x} <y> CAPS AB*C*", "no end", "end?  \n", "!!! ... ***", "w" * 4000,
    " ".join(f"w{i % 977} of" for i in range(9000)) + " the end.", "x y\x0bz\x1c q", "idiot scum " * 40,
]
WIDE = "doc_id long, text string, score double, held_out string, predicted int, label string, n int, ws string, lines int, row int, rest int, key int"


@pytest.fixture(scope="module")
def rows(spark):
    """Given documents, odd texts, a null id and rows of one id with equal and with other texts."""
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    own = [(10_000 + i, t) for i, t in enumerate(ODD)]
    return [*given, *own, (None, ODD[5]), (given[0][0], given[0][1]), (given[1][0], "another text of this id")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (WIDE.count(",") - 1)) for r in rows], WIDE).repartition(5)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def remainder(i, folds):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds


def matched(got, rows, score):
    """Every row has the score of its own text, whichever rows share its id."""
    want = sorted((i is None, i or 0, score(t)) for i, t in rows)
    have = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in got)
    assert [w[:2] for w in want] == [h[:2] for h in have]
    return np.array([w[2] for w in want]), np.array([h[2] for h in have])


def statistics(text):
    """The statistics of a text in the order of the operator's columns."""
    t = text or ""
    ws = [w for w in regex.split(r"\s+", t, flags=regex.ASCII) if w]
    lines = [x for x in t.split("\n") if x]
    n, n_ws, n_lines = len(t), len(ws), len(lines)

    def per(a, b):
        return a / b if b else 0.0

    def count(pattern):
        return len(regex.findall(pattern, t))

    return [
        log1p(n), log1p(n_ws), log1p(n_lines), per(n, n_ws), per(n_ws, n_lines), per(len(set(ws)), n_ws), per(len(set(lines)), n_lines),
        *[per(t.count(c), n_ws) for c in "|!#.,*"], per(t.count("{") + t.count("<"), n_ws),
        per(count(r"[#$%&*@^~=+|\\/<>{}\[\]_]"), n), per(count("[0-9]"), n), per(count(r"\p{Lu}"), n), per(count(r"(?<!\p{L})\p{Lu}{2,}"), n_ws),
        per(sum(len(w) <= 3 for w in ws), n_ws), per(sum(len(w) // 13 >= 1 for w in ws), n_ws),
        1.0 if regex.search(r"[.!?]\s*\Z", t, flags=regex.ASCII) else 0.0,
    ]


def test_quality_is_its_rules_over_the_statistics(docs, rows, labels, monkeypatch):
    models = []
    fit = rules.fit
    monkeypatch.setattr(rules, "fit", lambda *a: models.append(fit(*a)) or models[-1])
    got = rules.classify(docs, labels).collect()
    (ensemble, intercept), = models
    assert len(ensemble) > 1

    def score(text):
        x = statistics(text)
        z = intercept + sum(w for rule, w in ensemble if all((x[f] <= edge) == at_most for f, at_most, edge in rule))
        return 1 / (1 + exp(-z))

    want, have = matched(got, rows, score)
    assert np.abs(want - have).max() < 1e-9
    assert all(r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (remainder(r["doc_id"], 3) == 1) for r in got)


def sigmoid(x):
    return 1 / (1 + exp(-x))


def gated(p, d, xs):
    """Hidden states of one direction, element by element."""
    size = bigru.HIDDEN
    w, b, u = (p[k + d].astype(float).tolist() for k in ("w", "b", "u"))
    h, out = [0.0] * size, []
    for x in xs:
        g = [b[j] + sum(x[i] * w[i][j] for i in range(len(x))) for j in range(3 * size)]
        a = [sum(h[i] * u[i][j] for i in range(size)) for j in range(3 * size)]
        z = [sigmoid(g[j] + a[j]) for j in range(size)]
        r = [sigmoid(g[size + j] + a[size + j]) for j in range(size)]
        n = [tanh(g[2 * size + j] + r[j] * a[2 * size + j]) for j in range(size)]
        h = [(1 - z[j]) * n[j] + z[j] * h[j] for j in range(size)]
        out.append(h)
    return out


def vector(net, word):
    """Input of a word: its own vector, the mean of its n-grams' vectors, the largest log-odds of an n-gram."""
    word = word.strip(bigru.EDGES)
    whole, buckets = b"<" + word + b">", []
    for n in bigru.NGRAMS:
        for i in range(len(whole) - n + 1):
            h = n
            for c in whole[i : i + n]:
                h = (h * 1_000_003 % (1 << 32)) ^ c
            buckets.append((h * 2_654_435_761 % (1 << 32)) >> (32 - bigru.NGRAM_BITS))
    own = net.p["word"][net.vocabulary.get(word, len(net.vocabulary))].astype(float).tolist()
    if not buckets:
        return [*own, *[0.0] * bigru.CHAR_DIM, 0.0]
    grams = net.p["gram"][buckets].astype(float)
    return [*own, *(sum(g[j] for g in grams) / len(buckets) for j in range(bigru.CHAR_DIM)), float(max(net.gram_odds[b] for b in buckets))]


def window_logit(net, words):
    p = net.p
    xs = [vector(net, w) for w in words]
    hs = [f + b for f, b in zip(gated(p, "f", xs), reversed(gated(p, "b", xs[::-1])))]
    a, c, v, o = (p[k].astype(float).tolist() for k in ("a", "c", "v", "o"))
    marks = []
    for h in hs:
        e = [tanh(c[j] + sum(h[i] * a[i][j] for i in range(len(h)))) for j in range(bigru.ATTENTION)]
        marks.append(exp(sum(x * y for x, y in zip(e, v))))
    pooled = [sum(m * h[i] for m, h in zip(marks, hs)) / sum(marks) if marks else 0.0 for i in range(2 * bigru.HIDDEN)]
    return float(p["b"][0]) + sum(x * y for x, y in zip(pooled, o))


def test_toxicity_is_the_network_over_all_windows(docs, rows, labels, monkeypatch):
    nets = []
    train = bigru.train
    monkeypatch.setattr(bigru, "train", lambda *a, **k: nets.append(train(*a, **k)) or nets[-1])
    got = bigru.classify(docs, labels).collect()
    net, = nets
    assert net.scale[:2] != (0.0, 0.0)
    seen = {}

    def score(text):
        words = (text or "").encode().lower().split()
        starts = range(0, max(1, len(words) - bigru.WINDOW + bigru.STEP), bigru.STEP)
        logits = []
        for s in starts:
            part = tuple(words[s : s + bigru.WINDOW])
            if part not in seen:
                seen[part] = window_logit(net, part)
            logits.append(seen[part])
        top = sorted(logits, reverse=True)[:3]
        top += [top[-1]] * (3 - len(top))
        a, b, c = net.scale
        return sigmoid(a * top[0] + b * sum(top) / 3 + c)

    # the plain network is slow: every twelfth row, and the odd ones of fewer than 2,000 words
    ids = {i for i, t in rows if (i is None or i >= 10_000 or i % 12 == 0) and len((t or "").split()) < 2000}
    want, have = matched([r for r in got if r["doc_id"] in ids], [x for x in rows if x[0] in ids], score)
    assert len(want) > 20 and np.abs(want - have).max() < 1e-4
    assert all(r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (remainder(r["doc_id"], 5) == 0) for r in got)
    assert len(got) == len(rows)


@pytest.mark.parametrize("knobs", [{"clustered": 60, "held_words": 200, "known_words": 300}, {"clustered": 40, "classes": 9, "moves": 0}])
def test_class_model_is_its_counts(docs, rows, monkeypatch, knobs):
    held, tables, parts = [], [], []
    bigrams, matrix, near = brown.bigram_counts, brown.class_matrix, brown.neighbours

    def bigrams_seen(d, words):
        held.append(words.value)
        return bigrams(d, words)

    def near_seen(d, words, known, at, sizes):
        parts.append((known.value, at))
        return near(d, words, known, at, sizes)

    def matrix_seen(n, classes, *rest):
        tables.append((classes.value, matrix(n, classes, *rest)))
        return tables[-1][1]

    monkeypatch.setattr(brown, "bigram_counts", bigrams_seen)
    monkeypatch.setattr(brown, "neighbours", near_seen)
    monkeypatch.setattr(brown, "class_matrix", matrix_seen)
    got = brown.score_documents(docs, **knobs).collect()
    (words, clustered), (known, at) = held[0], parts[0]
    place = {w.encode(): i for i, w in enumerate(words)}
    known_at = {int(k): i for i, k in enumerate(known)}

    def class_of(word, classes):
        if not word:
            return int(classes[len(words)])
        if word in place:
            return int(classes[place[word]])
        # a known word is found by its hash with the highest bit set, others have the class of their length
        key = int(np.uint64(xxhash.xxh3_64_intdigest(word) | 1 << 63).astype(np.int64))
        if key in known_at:
            return int(classes[len(words) + 1 + known_at[key]])
        return int(at[min(clustered, len(words)) + min((len(word) - 1) // 2, brown.LENGTHS - 1)])

    def tokens(text):
        return [*(text or "").encode().lower().split(), b""]

    learned = [tokens(t) for i, t in rows if remainder(i, 7) != 2]
    n = Counter(w for ts in learned for w in ts)
    size = int(at.max()) + 1

    def counted(classes):
        m = [[0] * size for _ in range(size)]
        for ts in learned:
            for a, b in zip([b"", *ts], ts):
                m[class_of(a, classes)][class_of(b, classes)] += 1
        return m

    def likelihood(m):
        x = [[v * log(v) for v in row if v] for row in m]
        cols = [sum(row[j] for row in m) for j in range(size)]
        rows_ = [sum(row) for row in m]
        return sum(map(sum, x)) - sum(v * log(v) for v in rows_ if v) - sum(v * log(v) for v in cols if v)

    made = [(classes, counted(classes)) for classes, _ in tables]
    assert all((np.array(m) == table).all() for (_, m), (_, table) in zip(made, tables))
    # rounds that raise the likelihood are taken one after another; the first that does not ends it
    classes, m = made[0]
    for later in made[1:]:
        if likelihood(later[1]) <= likelihood(m):
            break
        classes, m = later
    kinds = Counter(class_of(w, classes) for w in n if w)
    totals = Counter()
    for w, k in n.items():
        totals[class_of(w, classes)] += k

    def score(text):
        out, before = 0.0, class_of(b"", classes)
        for w in tokens(text):
            c = class_of(w, classes)
            out += log10((m[before][c] + brown.ALPHA) / (sum(m[before]) + brown.ALPHA * size))
            if w:
                out += log10((n[w] + 1) / (totals[c] + kinds[c] + 1))
            before = c
        return out

    want, have = matched(got, rows, score)
    assert (np.abs(want - have) < 1e-6 * np.maximum(1, np.abs(want))).all()
    for r in got:
        assert abs(r["perplexity"] - 10 ** (-r["score"] / r["n_tokens"])) < 1e-6 * r["perplexity"]
        assert r["held_out"] == (remainder(r["doc_id"], 7) == 2)


def test_the_queries_are_the_operators(spark, labels):
    """The three queries apply these operators to the whole table with the defaults of their modules."""
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for name, rows in {
        "op4_quality_classifier": rules.classify(d, labels),
        "op7_toxicity": bigru.classify(d, labels),
        "op9_lm_scoring": brown.score_documents(d),
    }.items():
        got = {r["doc_id"]: r["score"] for r in queries.QUERIES[name](spark, SF).collect()}
        want = {r["doc_id"]: r["score"] for r in rows.collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 * max(1, abs(want[i])) for i in want)
