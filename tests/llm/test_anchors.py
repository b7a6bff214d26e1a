import random

import numpy as np
import pytest
import xxhash

from corpuslab.llm import anchors, queries
from corpuslab.llm.common import connected
from corpuslab.session import Scratch

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, threshold=3):
    """Smallest index reachable, by all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= threshold:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return [(i, f"{f:016x}", least.get(c)) for (i, _), f, c in zip(rows, fps, comp)]


def test_every_word_has_one_nearest_anchor_and_close_pairs_share_one():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    at, _ = anchors.anchors_of(fps, 0)
    assert at.tolist() == list(range(300))
    for flips in (1, 2, 3):
        other = fps.copy()
        for i in range(len(other)):
            for b in rng.choice(64, flips, replace=False):
                other[i] ^= np.uint64(1 << int(b))
        one, two = (set(zip(*map(np.ndarray.tolist, anchors.anchors_of(x, 2)))) for x in (fps, other))
        assert {i for i, _ in one & two} == set(range(300))


@pytest.mark.parametrize("threshold", [1, 3, 4])
def test_components_of_dense_and_sparse_fingerprints(spark, monkeypatch, threshold):
    rnd = random.Random(threshold)
    centre = rnd.getrandbits(64)
    fps = [rnd.getrandbits(64) for _ in range(40)]
    for _ in range(160):
        x = rnd.choice(fps[:20] + [centre] * 20)
        for _ in range(rnd.randint(0, 6)):
            x ^= 1 << rnd.randrange(64)
        fps.append(x)
    fps = sorted(set(fps))
    # full anchors are dealt over several tasks
    monkeypatch.setattr(anchors, "BLOCK", 8)
    monkeypatch.setattr(anchors, "LOOK", 1)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    scratch = Scratch(spark, "test")
    labels = {r["vid"]: r["comp"] for r in connected(anchors.linked(df, scratch, threshold), scratch).collect()}
    got = [labels.get(v, v) for v in (int(np.uint64(f).astype(np.int64)) for f in fps)]
    want = brute_components(fps, threshold)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_texts(spark):
    rnd = random.Random(5)
    long = [f"w{rnd.randrange(900)}" for _ in range(6000)]
    near = long[:]
    near[17] = "other"
    rows = [(7, None), (3, ""), (9, " \t"), (1, "One"), (2, "one"), (4, "one two"), (5, "ONE two three"), (6, "one two three four"), (8, " ".join(long)), (10, " ".join(near)),
            (11, " ".join(long)), (11, " ".join(long)), (None, "one two"), (None, "alone it stands here"), (12, "é É İ x"), (13, "a a a a a a")]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, fp string, copies int, comp int").repartition(3)
    got = sorted(map(str, ((r["doc_id"], r["fingerprint"], r["component_id"]) for r in anchors.simhash_duplicates(df).collect())))
    assert got == sorted(map(str, brute(rows)))
    assert anchors.simhash_duplicates(df.where("false")).count() == 0


def test_query_is_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op12_simhash_near_dedup"](spark, SF).collect()}
    assert got == set(brute(rows))
