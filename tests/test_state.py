import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from corpuslab.sources import manifests
from corpuslab.sources.runs import Runs
from corpuslab.streaming import registry, seen, state


def parts(path):
    return {(p, b) for p in os.listdir(path) if p.startswith("part=") for b in os.listdir(f"{path}/{p}") if b.startswith("bucket=")}


def keyed(spark, path, buckets=16):
    return state.KeyedState(spark, path, "k string, n long", "k", buckets)


def largest(old, new):
    return old.unionByName(new).groupBy("k").agg(F.max("n").alias("n"))


def test_batches_rewrite_their_own_buckets_only(spark, tmp_path):
    path, rng, want = str(tmp_path / "s"), random.Random(3), {}
    for number in range(6):
        batch = [(f"k{rng.randrange(300)}", rng.randrange(1000)) for _ in range(200 if number == 0 else 3)] + [(None, number)]
        for k, n in batch:
            want[k] = max(n, want.get(k, n))
        before = parts(path) if number else set()
        keyed(spark, path).upsert(spark.createDataFrame(batch, "k string, n long"), number, largest)
        assert number == 0 or len(parts(path) - before) <= 4
        assert dict(map(tuple, keyed(spark, path, 99).rows().collect())) == want
    assert keyed(spark, path, 99).buckets == 16 and manifests.numbers(spark, path) == [4, 5]
    # two versions are held: every bucket lies there once, and once more where the last batch wrote
    assert len(parts(path)) <= 16 + 4


def test_empty_batch_keeps_everything(spark, tmp_path):
    path = str(tmp_path / "s")
    none = spark.createDataFrame([], "k string, n long")
    keyed(spark, path).upsert(none, 0, largest)
    assert keyed(spark, path).rows().count() == 0
    keyed(spark, path).upsert(spark.createDataFrame([("a", 1)], "k string, n long"), 1, largest)
    keyed(spark, path).upsert(none, 2, largest)
    assert keyed(spark, path).rows().collect() == [("a", 1)] and keyed(spark, path).number == 2


def test_appended_parts_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "PARTS", 3)
    path = str(tmp_path / "s")
    for number in range(9):
        held = state.KeyedState(spark, path, "k string", "k", 2)
        rows = spark.createDataFrame([(f"{number}-{i}",) for i in range(4)] + [("0-1",), (None,)], "k string")
        held.append(spark.createDataFrame(held.unseen(rows).collect(), "k string"), number)
        assert max(map(len, held.parts.values())) <= 3
    got = [r["k"] for r in state.KeyedState(spark, path, "k string", "k").rows().collect()]
    assert len(got) == 9 * 4 + 1 and len(set(got)) == len(got)


def test_a_number_is_published_once(spark, tmp_path):
    manifests.publish(spark, str(tmp_path), 3, {"a": 1})
    with pytest.raises(manifests.Conflict):
        manifests.publish(spark, str(tmp_path), 3, {"a": 2})
    assert manifests.load(spark, str(tmp_path), 3) == {"a": 1} and os.listdir(tmp_path / "_manifests").count("000000000003.json") == 1


def test_batch_that_runs_again_changes_nothing(spark, tmp_path):
    """The commit of the batch is lost after its state was published; null is a link like any other."""
    src, held, out, cp = (str(tmp_path / x) for x in ("in", "seen", "out", "cp"))
    put = lambda *x: spark.createDataFrame([(i,) for i in x], "link string").coalesce(1).write.mode("append").parquet(src)
    run = lambda: seen.emit_unseen(seen.link_stream(spark, src, "link string"), held, out, cp).awaitTermination()
    put("a", None, "a")
    run()
    for name in os.listdir(f"{cp}/commits"):
        os.remove(f"{cp}/commits/{name}")
    put("b", None)
    run()
    got = [r["link"] for r in spark.read.schema("link string").parquet(out).collect()]
    assert sorted(map(str, got)) == ["None", "a", "b"]
    assert sorted(str(r["link"]) for r in seen.seen_keys(spark, held).collect()) == ["None", "a", "b"]


def test_last_size_of_a_file_counts(spark, tmp_path):
    src, held, cp = (str(tmp_path / x) for x in ("in", "state", "cp"))
    for rows in ([("x", 5, "r", 1), ("y", 9, "r", 1)], [("x", 2, "s", 2)]):
        spark.createDataFrame(rows, registry.SIZE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(registry.SIZE_SCHEMA).parquet(src)
        registry.unextractable(stream, held, cp, buckets=4).awaitTermination()
    assert sorted(map(tuple, registry.current(spark, held, registry.SIZE_SCHEMA).collect())) == [("x", 2, "s", 2), ("y", 9, "r", 1)]


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "term string")


def stored(runs, **which):
    return sorted(r["term"] for r in runs.table("terms", **which).collect())


def test_run_is_visible_as_a_whole(spark, tmp_path):
    runs = Runs(spark, str(tmp_path / "runs"))
    assert runs.names() == [] and runs.table("terms") is None
    first = runs.begin("2024-02-01")
    assert first.write("terms", frame(spark, "a")).count() == 1
    assert runs.table("terms") is None
    first.write("index", frame(spark))
    first.publish()
    assert stored(runs) == ["a"] and runs.table("index").count() == 0 and runs.table("other") is None
    killed = runs.begin("2024-02-02")
    killed.write("terms", frame(spark, "b"))  # it ends here, before its index
    assert runs.names() == ["2024-02-01"] and stored(runs) == ["a"]
    assert len(runs.forget_unpublished()) == 1 and stored(runs) == ["a"]
    again = runs.begin("2024-02-02")
    again.write("terms", frame(spark, "c"))
    with pytest.raises(ValueError, match="twice"):
        again.write("terms", frame(spark, "c"))
    again.publish()
    assert stored(runs) == ["c"] and stored(runs, before="2024-02-02") == ["a"] and runs.table("terms", before="2024-02-01") is None


def test_run_of_a_day_replaces_the_former_one_and_two_writers_do_not_mix(spark, tmp_path):
    runs = Runs(spark, str(tmp_path / "runs"))
    one, two = runs.begin("2024-02-01"), runs.begin("2024-02-01")
    one.write("terms", frame(spark, "a"))
    two.write("terms", frame(spark, "b"))
    one.publish()
    with pytest.raises(manifests.Conflict):
        two.publish()
    assert stored(runs) == ["a"]
    three = runs.begin("2024-02-01")
    three.write("terms", frame(spark, "c"))
    three.publish()
    assert stored(runs, run="2024-02-01") == ["c"] and runs.names() == ["2024-02-01"]


def test_bad_former_state_stops_before_any_write(spark, tmp_path):
    runs = Runs(spark, str(tmp_path / "runs"))
    run = runs.begin("2024-02-01")
    run.write("terms", frame(spark, "a"))
    run.publish()
    folder = next(f for f in os.listdir(tmp_path / "runs") if f.startswith("2024"))
    shutil.copytree(tmp_path / "runs", tmp_path / "other")
    os.remove(tmp_path / "runs" / folder / "terms" / "_SUCCESS")
    with pytest.raises(ValueError, match="incomplete"):
        runs.begin("2024-02-02")
    (tmp_path / "other" / "_manifests" / "000000000001.json").write_text("{")
    with pytest.raises(ValueError, match="no manifest"):
        Runs(spark, str(tmp_path / "other")).begin("2024-02-02")
    assert len([f for f in os.listdir(tmp_path / "other") if f.startswith("2024")]) == 1
