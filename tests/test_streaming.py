from corpuslab.streaming import registry, seen


def links(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "link string").coalesce(1).write.mode("append").parquet(path)


def test_links_come_out_once_over_runs(spark, tmp_path):
    src, state, out, cp = (str(tmp_path / x) for x in ("in", "seen", "out", "cp"))
    for batch in (["a", "b", "a"], ["b", "c"], []):
        if batch:
            links(spark, src, batch)
        seen.emit_unseen(seen.link_stream(spark, src, "link string"), state, out, cp).awaitTermination()
    assert sorted(r["link"] for r in spark.read.schema("link string").parquet(out).collect()) == ["a", "b", "c"]
    assert sorted(r["link"] for r in spark.read.schema("link string").parquet(state).collect()) == ["a", "b", "c"]


def test_repeated_batch_gives_the_same_rows(spark, tmp_path):
    """A lost checkpoint replays batch 0; its own seen rows do not hide it."""
    src, state, out = (str(tmp_path / x) for x in ("in", "seen", "out"))
    links(spark, src, ["a", "b"])
    for cp in ("cp1", "cp2"):
        seen.emit_unseen(seen.link_stream(spark, src, "link string"), state, out, str(tmp_path / cp)).awaitTermination()
        assert sorted(r["link"] for r in spark.read.schema("link string").parquet(out).collect()) == ["a", "b"]


def test_window_registry_never_shrinks(spark, tmp_path):
    src, state, cp = (str(tmp_path / x) for x in ("in", "state", "cp"))
    for rows in ([("x", 100), ("y", 5)], [("x", 50), ("y", 9)]):
        spark.createDataFrame(rows, registry.WINDOW_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(registry.WINDOW_SCHEMA).parquet(src)
        registry.uncleanable(stream, state, cp).awaitTermination()
    got = {r["raw_name"]: r["failed_window"] for r in registry.current(spark, state, registry.WINDOW_SCHEMA).collect()}
    assert got == {"x": 100, "y": 9}
