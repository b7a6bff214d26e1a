import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from corpuslab.llm import queries, trie
from corpuslab.session import Scratch

SF = "/root/testdata/sf0.001"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(role, text):
    return sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def conversations(rows):
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            out.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), role, text))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in out.items()}


def forked(convs):
    out = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(convs):
    """All nodes, by definition."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(node))
        out.append((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), sum(len(x) == len(node) + 1 for x in below), len(leaves), saved, sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def found(df):
    return sorted(str(tuple(r[n] for n in NAMES)) for r in df.collect())


def made(spark, rows):
    extra = "pos int, node string, p1 string, last int, size string"
    return spark.createDataFrame([(*r, 1, "x", "y", 2, "z") for r in rows], f"conv_id long, turn long, role string, text string, {extra}").repartition(3)


@pytest.mark.parametrize("cells", [trie.CHUNK, 1])
def test_is_brute_force(spark, monkeypatch, cells):
    """With one cell a row, the sketch proves nothing and all is grouped."""
    if cells == 1:
        monkeypatch.setattr(trie, "cells", lambda pos, one, two, width: np.zeros((trie.DEPTH, len(pos)), np.int64))
    rnd = random.Random(cells)
    rows = []
    for c in range(80):
        rows += [(c, t, rnd.choice(["user", "assistant"][: 1 + t]), rnd.choice("abc") * rnd.randint(1, 2)) for t in range(rnd.randint(1, 6))]
    rows += [(1000 + c, t, "user", "same") for c in range(60) for t in range(4)]
    assert found(trie.prefix_trie(made(spark, rows))) == brute(conversations(rows))
    assert found(trie.forked_trie(made(spark, rows))) == brute(forked(conversations(rows)))


def test_odd_rows(spark):
    rows = [(1, None, "user", "b"), (1, None, "user", "a"), (1, 0, None, None), (2, 0, "", ""), (3, 5, "user", ""), (3, 5, "user", ""), (None, 1, "user", "x"), (-7, 0, "us", "er"), (-8, 0, "user", ""), (205, 0, "user", "x"), (300, 0, "user", "x" * 50000)]
    assert found(trie.prefix_trie(made(spark, rows))) == brute(conversations(rows))
    assert found(trie.prefix_trie(made(spark, rows).where("false"))) == []
    rows = [r for r in rows if (r[0] or 0) >= 0]
    assert found(trie.forked_trie(made(spark, rows))) == brute(forked(conversations(rows)))
    assert found(trie.forked_trie(made(spark, rows).where("false"))) == []


def test_long_conversations_over_many_tasks(spark):
    """Three conversations of which two share 700 turns; their rows are sorted into many tasks."""
    rows = [(c, t, "user", f"turn {t if t < 700 else (t, c)}") for c in (4, 9) for t in range(900)] + [(6, t, "user", f"turn {t}") for t in range(500)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        seq = trie.sequenced(trie.facts(made(spark, rows), "conv_id", "turn", "role", "text"), Scratch(spark, "test"))
        kept = seq.orderBy("conv", "pos").collect()
        assert [(r["conv"], r["pos"], r["last"]) for r in kept] == [(c, p, p == n) for c, n in ((4, 900), (6, 500), (9, 900)) for p in range(1, n + 1)]
        of = {(r["conv"], r["pos"]): (r["p1"], r["p2"]) for r in kept}
        assert all(of[4, p] == of[9, p] for p in range(1, 701)) and all(of[4, p] == of[6, p] for p in range(1, 501))
        assert not any(of[4, p] == of[9, p] for p in range(701, 901)) and len(set(of.values())) == 1100
        assert all((r["q1"], r["q2"]) == of.get((r["conv"], r["pos"] - 1), (0, 0)) for r in kept)
        got = trie.prefix_trie(made(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == 1101
    by = {(r["conv_id"], r["depth"]): r for r in got}
    assert [by[4, d]["n_convs"] for d in (0, 500, 501, 700, 701, 900)] == [3, 3, 2, 2, 1, 1]
    assert by[4, 700]["n_children"] == 2 and by[9, 701]["parent_conv_id"] == 4 and by[4, 0]["n_leaves"] == 2
    assert by[4, 500]["ends_sha256"] == sha256(b"6").hexdigest()


def test_query_is_brute_force(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert found(queries.QUERIES["op11_prefix_trie"](spark, SF)) == brute(forked(conversations(rows)))
