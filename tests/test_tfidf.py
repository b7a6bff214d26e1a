import datetime as dt
import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuslab.operators import corpus as C
from corpuslab.operators import tfidf
from corpuslab.plans import reports


def by_hand(docs, stop, cap):
    """Scores from the definition, in plain Python."""
    feats = {}
    for d, text in docs.items():
        toks = [t for t in text.lower().split() if len(t) > 1 and t not in stop]
        feats[d] = Counter(toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])])
    cf, df = Counter(), Counter()
    for c in feats.values():
        cf.update(c)
        df.update(c.keys())
    vocab = {t for t, _ in sorted(cf.items(), key=lambda x: (-x[1], x[0]))[:cap]}
    n, sums = len(docs), Counter()
    for c in feats.values():
        w = {t: tf * (math.log((1 + n) / (1 + df[t])) + 1) for t, tf in c.items() if t in vocab}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t, x in w.items():
            sums[t] += x / norm
    return {t: round(s / n, 6) for t, s in sums.items()}


def corpus(seed=5):
    rnd = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "x", "omega"]
    return {i: " ".join(rnd.choices(words, k=rnd.randint(0, 25))) for i in range(30)}


@pytest.mark.parametrize("cap", [10000, 7])
def test_scores_match_the_definition(spark, cap):
    docs = corpus()
    df = spark.createDataFrame([(i, "c", t) for i, t in docs.items()], "doc long, channel string, document string")
    found = tfidf.entries(tfidf.weights(df, "doc", "document", cap=cap, stop_words=["the", "of"]))
    got = {r["term"]: r["score"] for r in found.collect()}
    want = by_hand(docs, {"the", "of"}, cap)
    assert got.keys() == want.keys()
    assert all(got[t] == pytest.approx(want[t], abs=1e-6) for t in want)


def test_groups_are_local_and_order_does_not_matter(spark):
    docs = corpus(6)
    rows = [(i, "c", f"b{i % 2}", t) for i, t in docs.items()]
    schema = "doc long, channel string, bucket string, document string"
    a = spark.createDataFrame(rows, schema)
    b = spark.createDataFrame(rows[::-1], schema).repartition(7)
    got = [
        sorted(map(tuple, tfidf.entries(tfidf.weights(x, "doc", "document", ["bucket"], stop_words=[]), ["bucket"]).drop("channels").collect()))
        for x in (a, b)
    ]
    assert got[0] == got[1]
    part = {t: s for bucket, t, s, _ in got[0] if bucket == "b0"}
    want = by_hand({i: t for i, t in docs.items() if i % 2 == 0}, set(), 10000)
    assert part.keys() == want.keys() and all(part[t] == pytest.approx(want[t], abs=1e-6) for t in want)


def test_empty_vocabulary(spark):
    df = spark.createDataFrame([(1, "c", "the of"), (2, "c", "")], "doc long, channel string, document string")
    assert tfidf.entries(tfidf.weights(df, "doc", "document")).collect() == []


def test_candidate_guards(spark):
    schema = "doc long, channel string, upload_date date, has_summary boolean"
    day = dt.date(2024, 2, 20)
    index = spark.createDataFrame([(1, "a", day, True), (2, "a", None, False), (3, "b", dt.date(2023, 1, 1), True)], schema)
    assert [r["doc"] for r in C.candidates(index, dt.date(2024, 3, 1), 30).collect()] == [1]
    with pytest.raises(ValueError, match="no channel"):
        C.candidates(index, dt.date(2024, 3, 1), channel="zz")
    undated = index.unionByName(spark.createDataFrame([(4, "a", None, True)], schema))
    with pytest.raises(ValueError, match="upload date"):
        C.candidates(undated, dt.date(2024, 3, 1))
    assert C.candidates(undated, dt.date(2024, 3, 1), channel="b").collect() == []


def test_emerging(spark):
    now = spark.createDataFrame([("a",), ("b",)], "term string")
    assert reports.emerging(now, None).collect() == []
    assert [r["term"] for r in reports.emerging(now, now.where("term = 'a'")).collect()] == ["b"]


def test_plan_has_no_python_and_no_cartesian(spark):
    df = spark.createDataFrame([(1, "c", "aa bb")], "doc long, channel string, document string")
    plan = tfidf.entries(tfidf.weights(df, "doc", "document"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_empty_summary_counts_as_missing(spark):
    df = spark.createDataFrame([(1, "**\n- \n"), (2, "# Two words")], "i int, text string")
    got = {r["i"]: (r["summary_words"], r["summary_chars"]) for r in C.summary_stats(df, "text").select("i", "summary_words", "summary_chars").collect()}
    assert got == {1: (None, None), 2: (2, 9)}
    assert df.where(F.col("i") > 5).count() == 0


def test_groups_may_be_taken_in_sets(spark, monkeypatch):
    rows = [(i, "c", f"b{i % 5}" if i % 6 else None, t) for i, t in corpus(7).items()]
    df = spark.createDataFrame(rows, "doc long, channel string, bucket string, document string")

    def found():
        return sorted((r["doc"], r["term"], r["tf"], r["df"], r["n_docs"], round(r["weight"], 12)) for r in tfidf.weights(df, "doc", "document", ["bucket"], cap=9, stop_words=[]).collect())

    whole = found()
    monkeypatch.setattr(tfidf, "ENTRIES", 18)
    assert found() == whole and whole
    with pytest.raises(ValueError, match="one group"):
        tfidf.weights(df, "doc", "document", ["bucket", "channel"])


def test_weights_move_neither_texts_nor_postings(spark):
    df = spark.createDataFrame([(i, "c", t) for i, t in corpus(8).items()], "doc long, channel string, document string")
    plan = tfidf.weights(df, "doc", "document")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan and "regexp" not in plan
    # repeated rows are documents of their own
    twice = tfidf.weights(spark.createDataFrame([(1, "c", "ab cd"), (1, "c", "ab")], df.schema), "doc", "document").collect()
    assert sorted((r["term"], round(r["weight"], 6)) for r in twice) == [("ab", 0.449436), ("ab", 1.0), ("ab cd", 0.631667), ("cd", 0.631667)]


def test_lookups_take_bounded_slices(spark, monkeypatch):
    """Tasks look up a few documents' terms at a time, however many rows a batch has."""
    docs = spark.createDataFrame([(i, "c", " ".join(f"w{i * j % 13}" for j in range(i % 9))) for i in range(60)], "i int, channel string, t string").repartition(2)

    def weights():
        return sorted((r["i"], r["term"], r["tf"], round(r["weight"], 9)) for r in tfidf.weights(docs, "i", "t", cap=5).collect())

    whole = weights()
    monkeypatch.setattr(tfidf, "READ_TERMS", 4)
    assert weights() == whole
    batch = pa.RecordBatch.from_pydict({"terms": [["a"] * (i % 5) for i in range(200)]})
    parts = list(tfidf.slices(batch, 0, 12))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert max(len(p.column(0).flatten()) for p in parts) <= 12 + 4
