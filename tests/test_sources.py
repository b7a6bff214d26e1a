import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import url_queue
from corpuslab.sources import files, writers


def test_text_tree_skips_sidecars(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "one.txt").write_text("x\ny")
    (tmp_path / "a" / "b" / "two.txt").write_text("z")
    (tmp_path / "a" / "._one.txt").write_text("junk")
    (tmp_path / "a" / "three.md").write_text("no")
    got = {r["name"]: r["text"] for r in files.text_files(spark, str(tmp_path), ".txt").collect()}
    assert got == {"one.txt": "x\ny", "two.txt": "z"}


def test_inbox_ignores_archives(spark, tmp_path):
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "x.txt").write_text("old\n")
    (tmp_path / "in.txt").write_text("  https://a.b \n\n\t\nsecond\n")
    assert sorted(r["line"] for r in files.inbox_lines(spark, str(tmp_path)).collect()) == ["https://a.b", "second"]
    before = files.inbox_snapshot(spark, str(tmp_path)).collect()
    (tmp_path / "in.txt").write_text("changed\n")
    assert before[0]["sha256"] != files.inbox_snapshot(spark, str(tmp_path)).collect()[0]["sha256"]


@pytest.mark.parametrize("split", [64, 1000, 1 << 27])
def test_lines_keep_their_places(spark, tmp_path, split):
    """Files of many splits, line ends of both kinds, empty lines, an empty file, a sidecar."""
    texts = {
        "a/one.log": [f"line {i} " + "x" * (i % 90) for i in range(300)],
        "a/two.log": ["", "only", "", "é"],
        "b/one.log": [str(i) for i in range(200)],
        "b/zero.log": [],
        "b/._one.log": ["junk"],
    }
    for name, lines in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(("\r\n" if name == "b/one.log" else "\n").join([*lines, ""] if lines else []).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        rows = files.ordered_lines(spark, str(tmp_path), ".log").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {}
    for r in rows:
        got.setdefault(r["path"].split(str(tmp_path) + "/")[1], []).append((r["line_number"], r["position"], r["line"]))
    one = len(texts["a/one.log"])
    assert {n: sorted(x) for n, x in got.items()} == {
        "a/one.log": [(i, i, t) for i, t in enumerate(texts["a/one.log"], 1)],
        "a/two.log": [(i, one + i, t) for i, t in enumerate(texts["a/two.log"], 1)],
        "b/one.log": [(i, i, t) for i, t in enumerate(texts["b/one.log"], 1)],
    }


def test_logs_are_written_in_order_by_several_tasks(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") % 10 > 2).cast("int").alias("log"), F.col("id").alias("event_id"), F.concat(F.lit("l"), "id").alias("line"))
    writers.write_logs(rows.orderBy(F.rand(3)), "log", "event_id", f"{tmp_path}/logs", per_file=700)
    back = files.ordered_lines(spark, f"{tmp_path}/logs", ".txt").collect()
    assert len({r["path"] for r in back}) > 5
    for log in (0, 1):
        own = [r["line"] for r in sorted((r for r in back if f"log={log}/" in r["path"]), key=lambda r: r["position"])]
        assert own == [f"l{i}" for i in range(5000) if (i % 10 > 2) == bool(log)]


def test_inventory_lists_without_content(spark, tmp_path):
    folder = tmp_path / "videos" / "chan" / "sub"
    folder.mkdir(parents=True)
    (folder / "A [id].mp4").write_bytes(b"12345")
    (folder / "empty.srt").write_bytes(b"")
    rows = files.inventory(spark, str(tmp_path)).orderBy("name").collect()
    assert [(r["stage"], r["channel"], r["dir"], r["name"], r["size"]) for r in rows] == [
        ("videos", "chan", "sub", "A [id].mp4", 5), ("videos", "chan", "sub", "empty.srt", 0),
    ]
    assert rows[0]["path"].endswith("/videos/chan/sub/A [id].mp4") and rows[0]["mtime"] > 0


def test_csv_quoting_and_header_check(spark, tmp_path):
    rows = spark.sql(
        "SELECT 'c' channel_id, timestamp_ntz'2024-01-01 10:00:00' published_at, 'a, \"b\"\nc' title, 3L duration_minutes, 'v' video_id"
    )
    path = str(tmp_path / "csv")
    writers.write_timeseries(rows, path)
    names = spark.createDataFrame([("c", "Chan")], "channel_id string, channel string")
    got = files.timeseries_csv(spark, path, names).first()
    assert (got["channel"], got["title"], got["published_at"]) == ("Chan", 'a, "b"\nc', "2024-01-01T10:00:00+00:00")
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.csv").write_text("wrong,header,a,b,c\n1,2,3,4,5\n")
    with pytest.raises(Exception, match="header|CSV"):
        files.timeseries_csv(spark, str(bad), names).collect()


def test_old_prediction_format_is_refused(spark, tmp_path):
    (tmp_path / "m1.csv").write_text("Script,Expected,Predicted,Match,Error\n/t/good_1.sh,PASS,PASS,Y,\n")
    row = files.prediction_csvs(spark, str(tmp_path)).first()
    assert (row["model"], row["item"]) == ("m1", "good_1.sh")
    old = tmp_path / "old"
    old.mkdir()
    (old / "m2.csv").write_text("Script,Expected,Actual,Match\n/t/good_1.sh,PASS,PASS,Y\n")
    with pytest.raises(Exception):
        files.prediction_csvs(spark, str(old)).collect()


def test_bookmark_json(spark, tmp_path):
    (tmp_path / "c.json").write_text("\n".join(json.dumps(x) for x in [{"_id": 1, "title": "r"}, {"_id": 2, "title": "s", "parent": {"$id": 1}}, {"title": "n"}]))
    assert sorted(map(tuple, files.collections_json(spark, str(tmp_path / "c.json")).collect())) == [(1, "r", None), (2, "s", 1)]


def test_raw_items_and_pending(spark, tmp_path):
    for kind, name, body in (("html", "a.html", "x"), ("html", "b.txt", "x"), ("text", "c.txt", ""), ("text", "._d.txt", "x")):
        (tmp_path / kind).mkdir(exist_ok=True)
        (tmp_path / kind / name).write_text(body)
    items = files.raw_items(spark, str(tmp_path))
    assert sorted(r["raw_name"] for r in items.collect()) == ["a.html", "c.txt"]
    cleaned = spark.createDataFrame([("html", "a", 3), ("text", "c", 0)], "content_type string, stem string, size long")
    assert [r["stem"] for r in files.pending_raw(items, cleaned).collect()] == ["c"]
    assert files.pending_raw(items, cleaned, include_cleaned=True).count() == 2


def test_index_overwrites_only_touched_channels(spark, tmp_path):
    path = str(tmp_path / "index")
    writers.write_index(spark.createDataFrame([(1, "a"), (2, "b")], "i int, channel string"), path)
    writers.write_index(spark.createDataFrame([(3, "a")], "i int, channel string"), path)
    assert sorted((r["i"], r["channel"]) for r in spark.read.parquet(path).collect()) == [(2, "b"), (3, "a")]


def test_ranking_and_exports(spark, tmp_path):
    ranking = spark.createDataFrame([("c1", 0.1), ("c2", 2.0)], "channel_id string, per_day double")
    writers.write_ranking(ranking, str(tmp_path / "rank"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "rank")).collect()) == ["c1", "c2"]
    leaf = spark.createDataFrame([("f", "leaf_001", "text", "{}")], "folder string, leaf string, node_text string, citation string")
    writers.write_exports(leaf, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).where(F.col("leaf") == "leaf_001").count() == 1


def test_texts_of_one_key_are_split_over_files(spark, tmp_path):
    rows = spark.createDataFrame([("hot", f"t{i}\nu") for i in range(50)] + [("cold", ""), ("cold", "x")], "source string, text string").repartition(3)
    writers.write_texts(rows, "source", str(tmp_path / "t"), per_file=8)
    found = files.text_files(spark, str(tmp_path / "t"), ".txt").collect()
    assert max(r["text"].count("u") for r in found) <= 8 and len([r for r in found if "=hot" in r["path"]]) >= 7
    lines = Counter(line for r in found for line in r["text"].removesuffix("\n").split("\n"))
    assert lines == Counter([f"t{i}" for i in range(50)] + ["u"] * 50 + ["", "x"])


def test_named_files_are_replaced_and_read_back(spark, tmp_path):
    folder = str(tmp_path / "inbox")
    rows = spark.createDataFrame([("a.txt", "x\ny\n"), ("b.txt", "Grüße"), ("c.txt", None), (None, "lost")], "name string, text string")
    assert writers.write_named(rows, "name", "text", folder) == 3
    then = files.inbox_snapshot(spark, folder).collect()
    assert writers.write_named(spark.createDataFrame([("a.txt", "x\n")], rows.schema), "name", "text", folder) == 1
    assert writers.write_named(rows.limit(0), "name", "text", folder) == 0
    assert {p.name: p.read_text("utf-8") for p in (tmp_path / "inbox").iterdir()} == {"a.txt": "x\n", "b.txt": "Grüße", "c.txt": ""}
    left = url_queue.consumable(spark.createDataFrame(then), files.inbox_snapshot(spark, folder))
    assert {r["path"].rsplit("/", 1)[-1] for r in left.collect()} >= {"b.txt"}
    assert "a.txt" not in {r["path"].rsplit("/", 1)[-1] for r in left.collect()}
