import random

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import ranges, running
from corpuslab.operators.topn import top_per_group


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(running, "BLOCK", 3)


def rows_for(seed):
    rnd = random.Random(seed)
    rows = []
    for key in ("hot", "b"):
        positions = rnd.sample(range(200), 60 if key == "hot" else 7)
        rows += [(key, p, rnd.randint(1, 9), rnd.choice([None, f"v{p}"])) for p in positions]
    rnd.shuffle(rows)
    return rows


def test_running_folds_match_a_plain_loop(spark, small_blocks):
    rows = rows_for(1)
    df = spark.createDataFrame(rows, "k string, p long, v long, s string")
    out = running.running(df, ["k"], "p", F.col("v"), "total")
    out = running.running(out, ["k"], "p", F.col("v"), "top_before", how="max", inclusive=False)
    out = running.running(out, ["k"], "p", F.col("s"), "filled", how="last")
    got = {(r["k"], r["p"]): (r["total"], r["top_before"], r["filled"]) for r in out.collect()}
    want = {}
    for key in ("hot", "b"):
        total, top, last = 0, None, None
        for _, p, v, s in sorted(r for r in rows if r[0] == key):
            total += v
            last = s if s is not None else last
            want[(key, p)] = (total, top, last)
            top = v if top is None else max(top, v)
    assert got == want


def test_running_number_without_keys(spark, small_blocks):
    df = spark.createDataFrame([(p,) for p in (40, 2, 11, 3, 25)], "p long")
    got = {r["p"]: r["n"] for r in running.running_number(df, [], "p", "n").collect()}
    assert got == {2: 1, 3: 2, 11: 3, 25: 4, 40: 5}


def test_overlap_join_finds_each_pair_once(spark):
    rnd = random.Random(3)
    left = [("a", i, s, s + rnd.randint(0, 40)) for i, s in enumerate(rnd.choices(range(100), k=25))]
    right = [("a", i, s, s + rnd.randint(0, 40)) for i, s in enumerate(rnd.choices(range(100), k=25))]
    l_df = spark.createDataFrame(left, "k string, i int, ls long, le long")
    r_df = spark.createDataFrame(right, "k string, j int, rs long, re long")
    got = sorted((r["i"], r["j"]) for r in ranges.overlap_join(l_df, r_df, ["k"], ("ls", "le"), ("rs", "re"), width=8).collect())
    want = sorted((i, j) for _, i, ls, le in left for _, j, rs, re_ in right if le > ls and re_ > rs and ls < re_ and rs < le)
    assert got == want


def test_point_join_keeps_points_outside(spark):
    points = spark.createDataFrame([("a", 5), ("a", 10), ("a", 99), ("z", 1)], "k string, p long")
    spans = spark.createDataFrame([("a", 0, 10), ("a", 10, 20)], "k string, s long, e long")
    got = {(r["k"], r["p"]): r["s"] for r in ranges.point_join(points, spans, ["k"], "p", ("s", "e"), width=4).collect()}
    assert got == {("a", 5): 0, ("a", 10): 10, ("a", 99): None, ("z", 1): None}


def test_top_per_group_with_salt(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    got = sorted((r["g"], r["v"]) for r in top_per_group(df, ["g"], [F.desc("v")], 2, spread_on="v").collect())
    assert got == [(0, 496), (0, 498), (1, 497), (1, 499)]
