import math
import random

import numpy as np
import pytest

from corpuslab.llm import negatives, queries

SF = "/root/testdata/sf0.001"


def brute(rows, every=100, positives=5, keep=10):
    """All scores of all anchors, by definition."""
    used = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        used.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for at, (i, v, label) in enumerate(used):
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, lab) for k, (j, w, lab) in enumerate(used) if k != at]
        scored.sort(key=lambda s: s[:2])
        best = [s for s in scored if s[2] == label][:positives]
        for p, pid, _ in best:
            fit = [(s, j) for s, j, lab in scored if lab != label and 30 * -p <= 100 * -s <= 90 * -p][:keep]
            out += [(i, pid, r, j, -p, -s) for r, (s, j) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, **options):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in negatives.hard_negatives(df, **options).collect())


def made(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1, 2.0) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, row string, id int, score double").repartition(3)


@pytest.mark.parametrize("block", [7, 40, 1 << 15])
def test_is_brute_force(spark, monkeypatch, block):
    rnd = random.Random(block)
    monkeypatch.setattr(negatives, "STEP_FIRST", 4)
    monkeypatch.setattr(negatives, "MEMBERS", 3)
    centre = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(180):
        label = rnd.randrange(3)
        c = rnd.choice(centre)
        rows.append((i, [x + rnd.gauss(0, 0.3) for x in c], label))
    assert mined(made(spark, rows), every=9, block=block, clusters=4) == brute(rows, 9)


def test_odd_rows(spark):
    rnd = random.Random(2)
    rows = [(i, [round(rnd.uniform(-2, 2), 1) for _ in range(3)], i % 2) for i in range(40)]
    # nulls, no numbers, ties, copies of anchors, zero, short, empty and long vectors
    rows += [(None, [1.0, 1.0, 1.0], 1), (300, None, 1), (301, [1.0, 1.0, 1.0], None), (302, [1.0, None, 2.0], 0), (303, [1.0, float("nan"), 2.0], 0), (304, [float("inf"), 1.0, 1.0], 0)]
    rows += [rows[0], rows[10], (50, rows[10][1], 1), (51, rows[10][1], 0), (60, [0.0, 0.0, 0.0], 0), (61, [1.5], 1), (70, [], 0), (62, [1.0, 1.0, 1.0, 3.0], 1)]
    assert mined(made(spark, rows), every=10, block=9, clusters=3) == brute(rows, 10)
    assert mined(made(spark, rows).where("false")) == []
    assert mined(made(spark, [(100, [1.0], 1)])) == []
    own = spark.createDataFrame([(5,), (5,), (None,)], "a long")
    assert {r[0] for r in mined(made(spark, rows), anchors=own)} <= {5}


def test_large_numbers_are_exact_or_an_error():
    a = np.array([[1 << 29, 3], [1 << 28, 1]])
    assert negatives.exact(a, a).tolist() == [[(1 << 58) + 9, (1 << 57) + 3], [(1 << 57) + 3, (1 << 56) + 1]]
    with pytest.raises(ValueError, match="64 bits"):
        negatives.exact(a << 4, a)


def test_walk_stops_before_the_end(monkeypatch):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(4000, 4)) * 100).astype(np.int64)
    direction, norm = negatives.unit(x)
    block = {"x": x, "direction": direction, "norm": norm, "id": np.arange(4000), "row": np.arange(4000), "label": np.zeros(4000, np.int64)}
    members = {k: block[k][:3] for k in ("x", "row", "label")}
    members["x"] = x[[0, 0, 0]] + 1
    looked = []
    real = negatives.exact
    monkeypatch.setattr(negatives, "exact", lambda a, b: looked.append(len(b)) or real(a, b))
    edge = np.full((3, 1), 1 << 62)
    w = negatives.walk(block, members, negatives.unit(members["x"][:1])[0][0], -edge, edge, 5, True)
    assert sum(looked) < 2000
    for m in range(3):
        score = x @ members["x"][m]
        want = sorted((i for i in range(4000) if i != m), key=lambda i: (-score[i], i))[:5]
        assert w.id[w.slot == m].tolist() == want


def test_query_is_brute_force(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect():
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        rows.append((r["vec_id"], r["embedding"], label))
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    got = sorted(tuple(r[n] for n in names) for r in queries.QUERIES["op13_hard_negatives"](spark, SF).collect())
    assert got == brute(rows) and got
