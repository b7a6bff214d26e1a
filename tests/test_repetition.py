import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslab.functions import scores
from corpuslab.functions import text as T
from corpuslab.operators import loops
from corpuslab.operators import repetition as R
from corpuslab.operators.cues import cue_windows, word_offsets


def brute_runs(words, r):
    """Every maximal run at its primitive period, by definition."""
    n, out = len(words), set()
    for k in range(1, n // r + 1):
        same = [words[i] == words[i + k] for i in range(n - k)] + [False]
        start = None
        for i, ok in enumerate(same):
            if ok and start is None:
                start = i
            if not ok and start is not None:
                reps = (i - start) // k + 1
                phrase = words[start : start + k]
                primitive = not any(k % d == 0 and phrase == phrase[:d] * (k // d) for d in range(1, k))
                if reps >= r and primitive:
                    out.add((start, k, reps))
                start = None
    return out


def runs(spark, texts, r=5):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.words("t").alias("w"))
    out = {i: set() for i in range(len(texts))}
    for row in R.repeated_runs(df, "w", r).collect():
        out[row["i"]].add((row["start"], row["k"], row["repetitions"]))
    return [out[i] for i in range(len(texts))]


@pytest.mark.parametrize("r", [2, 3, 5])
def test_runs_match_brute_force(spark, r):
    rnd = random.Random(r)
    texts = []
    for _ in range(25):
        base = [rnd.choice("abc") for _ in range(rnd.randint(0, 30))]
        phrase = [rnd.choice("xyab") for _ in range(rnd.randint(1, 6))]
        texts.append(" ".join(base + phrase * rnd.randint(1, 9) + base[: rnd.randint(0, 10)]))
    assert runs(spark, texts, r) == [brute_runs(t.split(), r) for t in texts]


def hits(spark, text):
    df = spark.createDataFrame([(1, text)], "i int, t string").select("i", T.words(T.prepare("t")).alias("w"))
    found = R.outermost(R.classify(R.repeated_runs(df, "w")).drop("w"), ["i"])
    return [(r["start"], r["k"], r["repetitions"]) for r in found.collect()]


def test_known_answers(spark):
    assert hits(spark, " ".join(["you know, like,"] * 15)) == [(0, 3, 15)]
    assert hits(spark, "as like a, as like a, an object schema") == []
    assert hits(spark, "for this work, for this work, for this work, the xi") == []
    assert hits(spark, " ".join(["word"] * 5)) == []
    assert hits(spark, " ".join(["word"] * 11)) == [(0, 1, 11)]
    assert hits(spark, "y y y y y y y y s") == [(0, 1, 8)]


@pytest.mark.parametrize(("k", "least"), [(1, 7), (2, 7), (3, 6), (4, 5)])
def test_accepted_boundaries(spark, k, least):
    phrase = " ".join(f"w{i}" for i in range(k))
    assert hits(spark, " ".join([phrase] * least)) == [(0, k, least)]
    if least > 5:
        assert hits(spark, " ".join([phrase] * (least - 1))) == []


def test_scores(spark):
    row = spark.range(1).select(
        scores.linear_score(F.lit(10.0), F.lit(2.0)).alias("a"), scores.probability(F.lit(0.0)).alias("p"),
        scores.quadratic_score(F.lit(0.0), F.lit(0.0)).alias("q"),
    ).first()
    assert row["a"] == pytest.approx(0.888846 * 10 + 0.666538 * 2 - 6.777051)
    assert row["p"] == 0.5 and row["q"] == pytest.approx(-15.5181124275 - 0.0005429170)


def timed(spark, rows):
    df = spark.createDataFrame(rows, "t string, i long, content string")
    placed = word_offsets(df, "t", "i", F.col("content"))
    return placed.withColumns(
        {"words": T.words("content"), "start_ms": F.col("i") * 1000, "end_ms": F.col("i") * 1000 + 999}
    )


def test_loop_over_many_cues_is_collapsed(spark):
    rows = [("t", 0, "before the loop"), *[("t", i, "thank you") for i in range(1, 41)], ("t", 41, "thank you and bye"), ("t", 42, "end")]
    rows += [("calm", i, f"plain words {i}") for i in range(3)]
    cues = timed(spark, rows)
    merged = R.transcript_hits(cues, "t", "i", "words")
    assert [(r["hit_start"], r["hit_end"], r["k"], r["repetitions"]) for r in merged.collect()] == [(3, 85, 2, 41)]
    spans = R.hit_cue_spans(merged, cues, "t", "i").first()
    assert (spans["cue_from"], spans["cue_to"], spans["n_cues"]) == (1, 41, 41)
    cleaned = R.collapse_in_cues(cues, merged, "t", "i", "words").orderBy("t", "i").collect()
    got = [(r["t"], r["new_index"], r["content"]) for r in cleaned]
    assert got == [
        ("calm", 1, "plain words 0"), ("calm", 2, "plain words 1"), ("calm", 3, "plain words 2"),
        ("t", 1, "before the loop"), ("t", 2, "thank you and bye"), ("t", 3, "end"),
    ]


def test_windows_cover_every_word_once_or_more(spark):
    rows = [("t", i, " ".join(f"w{i}_{j}" for j in range(i % 7))) for i in range(60)]
    cues = timed(spark, rows)
    total = sum(len(c.split()) for _, _, c in rows)
    windows = R.word_windows(cues, "t", "i", "words", size=20, overlap=25.0).collect()
    seen = set()
    for w in windows:
        seen |= {w["window_start"] + j for j in range(len(w["words"]))}
        assert len(w["words"]) <= 20
    assert seen == set(range(total))


def test_training_rows(spark):
    df = spark.createDataFrame([(1, "a b " * 8), (2, "one two")], "i int, t string").select("i", T.words("t").alias("w"))
    got = {r["i"]: (r["repetitions"], r["sequence_length"], r["area"]) for r in R.training_rows(df, "i", "w").collect()}
    assert got == {1: (8, 2, 16), 2: (0, 0, 0)}


def cut(words, name, rnd, most=9):
    """Cues of a transcript, some without words."""
    rows, i = [], 0
    while words:
        n = rnd.randint(0, most)
        rows.append((name, i, " ".join(words[:n])))
        words, i = words[n:], i + 1
    return rows


@pytest.mark.parametrize(("phrase", "nxt", "block"), [(1024, 16, 16), (4, 2, 4), (2, 4, 2)])
def test_runs_of_whole_transcripts_match_brute_force(spark, monkeypatch, phrase, nxt, block):
    """Small blocks put borders into every run and need several levels."""
    monkeypatch.setattr(loops, "PHRASE", phrase)
    monkeypatch.setattr(loops, "NEXT", nxt)
    monkeypatch.setattr(loops, "BLOCK", block)
    rnd = random.Random(phrase)
    rows, want = [], set()
    for t in range(14):
        words = []
        for _ in range(rnd.randint(1, 4)):
            words += [rnd.choice("abcd") for _ in range(rnd.randint(0, 40))]
            k = rnd.choice([1, 1, 2, 3, 5, 8, 9, 16, 17, 23])
            one = [rnd.choice("xyab") for _ in range(k)]
            words += one * rnd.randint(3, 8) + one[: rnd.randint(0, k)]
        rows += cut(words, f"t{t}", rnd)
        want |= {(f"t{t}", *r) for r in brute_runs(words, 5)}
    got = R.transcript_runs(timed(spark, [*rows, (None, 0, "a " * 9)]), "t", "i", "words").collect()
    assert {(r["t"], r["start"], r["k"], r["repetitions"]) for r in got} == want and len(got) == len(want)
    assert all(r["run_end"] == r["start"] + r["k"] * r["repetitions"] <= r["reach"] for r in got)


def test_long_phrases_anywhere(spark):
    """What windows of 500 words cannot see: long phrases, and loops over a block's border."""
    rnd = random.Random(4)

    def words(n):
        return [f"w{rnd.randrange(10**9)}" for _ in range(n)]

    border = loops.PHRASE * loops.BLOCK
    made = {
        "from 300": words(300) + words(50) * 5 + words(80),
        "long": words(7) + words(120) * 5,
        "very long": words(100) + words(1500) * 5 + words(3),
        "border": words(border - 250) + words(100) * 5 + words(9),
        "loop": words(border - 9) + ["so"] * 60000 + words(2),
        "four": words(120) * 4,
    }
    rows = [r for name, ws in made.items() for r in cut(ws, name, rnd, 3000)]
    got = {(r["t"], r["hit_start"], r["hit_end"], r["k"], r["repetitions"]) for r in R.transcript_hits(timed(spark, rows), "t", "i", "words").collect()}
    assert got == {
        ("from 300", 300, 550, 50, 5), ("long", 7, 607, 120, 5), ("very long", 100, 7600, 1500, 5),
        ("border", border - 250, border + 250, 100, 5), ("loop", border - 9, border + 59991, 1, 60000),
    }


def test_time_of_a_loop_is_linear():
    def seconds(n):
        x, core = np.full(n, 7, np.uint64), np.ones(n, bool)
        start = time.process_time()
        found = loops.found_in(x, core, n // 5, 5)
        assert [tuple(f) for f in found.tolist() if f[3] == 1] == [(1, n, 1, 1)]
        return time.process_time() - start

    seconds(1 << 15)
    assert seconds(1 << 19) < 3.5 * seconds(1 << 18) + 0.2


def test_empty_and_null_words(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a"] * 9)], "i int, w array<string>")
    assert [(r["i"], r["k"], r["repetitions"], len(r["w"])) for r in R.repeated_runs(df, "w").collect()] == [(3, 1, 9, 9)]
    assert R.repeated_runs(df.where("false"), "w").count() == 0
    assert R.transcript_runs(timed(spark, [("a", 0, "")]).where("false"), "t", "i", "words").count() == 0


def brute_cue_windows(sizes, size, overlap):
    """The loop: grow by cues, then let cues go."""
    out, first, n = [], 0, 0
    for i, words in enumerate(sizes):
        n += words
        if i == len(sizes) - 1 or n >= size:
            out.append((len(out), first, i, sum(sizes[:first]), sum(sizes[: i + 1])))
            while n > size * overlap / 100:
                n -= sizes[first]
                first += 1
    return out


def test_cue_windows_are_those_of_the_loop(spark):
    rnd = random.Random(8)
    sizes = {f"t{t}": [rnd.choice([0, 0, 1, 2, 3, 7, 20]) for _ in range(rnd.randint(1, 70))] for t in range(25)}
    sizes |= {"none": [0, 0, 0], "one": [3], "large": [50, 60], "long": [1] * 900}
    rows = [(t, i, " ".join(["w"] * n)) for t, own in sizes.items() for i, n in enumerate(own)]
    cues = timed(spark, rows)
    for size, overlap in ((20, 25.0), (7, 0.0), (10, 33.0)):
        got = {}
        for r in cue_windows(cues, "t", "i", size, overlap).collect():
            got.setdefault(r["t"], []).append((r["window_index"], r["cue_from"], r["cue_to"], r["window_start"], r["window_end"]))
        assert {t: sorted(w) for t, w in got.items()} == {t: brute_cue_windows(own, size, overlap) for t, own in sizes.items()}
    assert cue_windows(cues.where("false"), "t", "i").count() == 0
    with pytest.raises(ValueError, match="overlap"):
        cue_windows(cues, "t", "i", 10, 100.0)
