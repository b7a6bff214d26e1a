"""Inputs beyond what earlier limits let through."""

import html
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuslab import session
from corpuslab.functions import text as T
from corpuslab.catalog import audit_queries
from corpuslab.operators import hierarchy, intervals, inventory, language, matching, pages, search
from corpuslab.plans import reports
from corpuslab.sources import files, writers
from corpuslab.streaming import registry, seen


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text",
    [
        "caf&oacute; &rarr; &eacute;", "&copy 2024 &copyright; &notit; &unknown; & &&amp;", "&#233;&#xE9;&#x80;&#150;&#0;&#xD800;&#1114112;",
        "&frac12;&CounterClockwiseContourIntegral;&amp;lt;", "a&#38b &#38;#38; &lt&gt", "plain",
    ],
)
def test_references_decode_as_in_html(spark, text):
    assert one(spark, text, pages.decode_entities) == html.unescape(text)


def test_family_looks_at_whole_pages(spark):
    body = '<article class="newsletter-post post">x</article>' + " " * 300_000 + "<!-- substackcdn.com -->"
    assert one(spark, body, pages.page_family) == "substack"


def test_regions(spark):
    assert one(spark, '<BODY class="a">in</Body> out', lambda c: pages.enclosed(c, "body")) == "in"
    assert one(spark, "<bodyguard>no</bodyguard>", lambda c: pages.enclosed(c, "body")) is None
    two = '<article>first</article><article data-x="1" class="post newsletter-post">second</article>'
    assert one(spark, two, pages.post_article) == "second"
    assert one(spark, two.replace("newsletter-", ""), pages.post_article) == "first"


@pytest.mark.parametrize("text,found", [("a <div class='x'> b", True), ("a </P> b", True), ("a < b > c", False), ("<custom>", False), ("`<b>`", False), ("<br/>", True), ("<div", False)])
def test_inline_tags(spark, text, found):
    assert one(spark, text, pages.has_inline_html) is found


def test_inline_markup(spark):
    assert one(spark, "**bold *both* x** and `code` [link](http://a) ***all***", T.clean_inline) == "bold both x and code link all"
    assert one(spark, "intro **NEW YORK, N.Y.** — text **BERLIN** — more", T.dateline) == "NEW YORK, N.Y."
    assert one(spark, "no **Place** — here", T.dateline) == ""
    assert one(spark, "![a](https://x/1.png) ![b](http://x/2) ![c](https://x/3)", T.image_urls) == ["https://x/1.png", "https://x/3"]


def test_inbox_takes_every_file(spark, tmp_path):
    for name in ("a.txt", "b.md", "c"):
        (tmp_path / name).write_text(f"https://{name}\n\n")
    for below in ("done", "unprocessed"):
        (tmp_path / below).mkdir()
        (tmp_path / below / "d.txt").write_text("https://d\n")
    assert {r["line"] for r in files.inbox_lines(spark, str(tmp_path)).collect()} == {"https://a.txt", "https://b.md", "https://c"}
    assert files.inbox_snapshot(spark, str(tmp_path)).count() == 3


def test_channels_without_limit_row_stay(spark):
    todo = spark.createDataFrame([(c, i) for c in "abc" for i in range(4)], "channel string, doc_id int")
    limits = spark.createDataFrame([("a", 1), ("b", 0)], "channel string, item_limit int")
    count = lambda df: dict(df.groupBy("channel").count().collect())
    assert count(inventory.limited_per_channel(todo, limits, ["doc_id"])) == {"a": 1, "c": 4}
    assert count(inventory.limited_per_channel(todo, limits, ["doc_id"], default_limit=2)) == {"a": 1, "c": 2}


def test_language_model_keeps_every_gram(spark):
    words = " ".join(chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676) for i in range(2600))
    docs = spark.createDataFrame([("en", words), ("de", "der die das")], "lang string, text string")
    spaced = [f" {words} ", " der die das "]
    want = {t[i : i + 3] for t in spaced for i in range(len(t) - 2)}
    assert {r["gram"] for r in language.train(docs, "lang", "text").collect()} == want and len(want) > 2000


def test_second_run_of_a_day_replaces_the_first(spark, tmp_path):
    frame = lambda *t: spark.createDataFrame([(x,) for x in t], "term string")
    path = f"{tmp_path}/snapshots"
    writers.write_snapshot(frame("old"), frame("old phrase"), "2024-03-01", path)
    writers.write_snapshot(frame("a"), frame("a b"), "2024-03-01", path)
    writers.write_snapshot(frame("c"), frame("c d"), "2024-03-02", path)
    got = spark.read.parquet(path).select(F.col("run_day").cast("string"), "kind", "term").collect()
    assert sorted(map(tuple, got)) == [("2024-03-01", "phrase", "a b"), ("2024-03-01", "term", "a"), ("2024-03-02", "phrase", "c d"), ("2024-03-02", "term", "c")]


def test_lost_checkpoint_keeps_what_was_stored(spark, tmp_path):
    base = str(tmp_path)
    put = lambda *x: spark.createDataFrame([(i,) for i in x], "link string").coalesce(1).write.mode("append").parquet(f"{base}/in")
    run = lambda cp: seen.emit_unseen(seen.link_stream(spark, f"{base}/in", "link string"), f"{base}/seen", f"{base}/out", f"{base}/{cp}").awaitTermination()
    put("a", "b", "a")
    run("cp")
    put("b", "c")
    run("cp")
    run("cp2")  # the checkpoint is lost: everything arrives again
    put("d")
    run("cp2")
    out = Counter(r["link"] for r in spark.read.schema("link string").parquet(f"{base}/out").collect())
    assert out == Counter("abcd")


def test_registry_survives_a_lost_checkpoint(spark, tmp_path):
    base = str(tmp_path)
    put = lambda *x: spark.createDataFrame(list(x), registry.WINDOW_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = lambda: spark.readStream.schema(registry.WINDOW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    put(("a", 5))
    put(("b", 7))
    registry.uncleanable(stream(), f"{base}/state", f"{base}/cp").awaitTermination()
    put(("c", 9))
    registry.uncleanable(stream(), f"{base}/state", f"{base}/cp2").awaitTermination()
    assert sorted(map(tuple, registry.current(spark, f"{base}/state", registry.WINDOW_SCHEMA).collect())) == [("a", 5), ("b", 7), ("c", 9)]


def test_rows_without_key_leave_the_join(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 10, F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("1", "x"), (None, "never")], "k string, v string")
    got = matching.left_join_known(left, right, "k").collect()
    assert len(got) == 1000 and [r["id"] for r in got if r["v"] is not None] == [1]


def test_special_collections_need_no_path(spark):
    items = spark.createDataFrame([(-1, "a"), (-99, "b"), (1, "c"), (7, "d"), (None, "e")], "collection_id long, link string")
    nodes = spark.createDataFrame([(1, "root", None)], "id long, title string, parent_id long")
    got = {r["link"]: r["path"] for r in hierarchy.with_paths(items, nodes, "collection_id").collect()}
    assert got["a"] == "Unsorted" and got["b"] == "Trash" and got["c"] == "root" and got["d"] == "Unknown(7)"


def test_time_remap_makes_no_rows_by_length(spark):
    kept = spark.createDataFrame([("r", 0, 10, 0, 10), ("r", 50, 10**12, 10, 10**12 - 40)], "k string, from_ms long, to_ms long, trimmed_from long, trimmed_to long")
    points = spark.createDataFrame([("r", t) for t in (0, 10, 11, 10**11, 10**12)] + [("r", 11), ("s", 1), ("r", -5)], "k string, t long")
    got = Counter((r["k"], r["t"], r["original_ms"]) for r in intervals.to_original(points, kept, "k", "t").collect())
    assert got == Counter([("r", 0, 0), ("r", 10, 10), ("r", 11, 51), ("r", 11, 51), ("r", 10**11, 10**11 + 40), ("r", 10**12, None), ("s", 1, None), ("r", -5, None)])


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(), "x")


def test_ranks_within_a_corpus(spark):
    rows = [("a", i, i % 3) for i in range(50)] + [("b", 7, 1)]
    found = spark.createDataFrame(rows, "corpus string, id long, n_lines long")
    got = {(r["corpus"], r["id"]): r["rank"] for r in search.research_ranks(found, "id").collect()}
    order = sorted((r for r in rows if r[0] == "a"), key=lambda r: (-r[2], r[1]))
    assert [got[("a", r[1])] for r in order] == list(range(1, 51)) and got[("b", 7)] == 1


def test_first_run_has_nothing_before_it(spark, tmp_path):
    terms = spark.createDataFrame([("a",)], "term string")
    writers.write_snapshot(terms, terms.limit(0), "2024-03-01", str(tmp_path))
    assert writers.stored_run(spark, str(tmp_path), "term", "2024-03-01") is None
    assert reports.emerging(writers.stored_run(spark, str(tmp_path), "term"), None).count() == 0


def test_predictions_sum_over_labels(spark):
    docs = spark.createDataFrame([("en", "the then there"), ("de", "der die das dies")], "lang string, text string")
    model = language.train(docs, "lang", "text")
    asked = spark.createDataFrame([(1, "then the"), (2, "dies das"), (3, "123"), (4, "zzz")], "id int, t string")
    got = {r["id"]: (r["predicted"], r["confidence"]) for r in language.predict(asked, ["id"], "t", model).collect()}
    assert got[1][0] == "en" and got[2][0] == "de" and got[1][1] > 0.9 and got[3] == ("??", 0.0) and got[4] == ("??", 0.0)


def test_predictions_do_not_depend_on_what_tasks_hold(spark, monkeypatch):
    texts = [(i % 90 if i % 17 else None, ["en", "de", "fr"][i % 3], " ".join(f"{'abc'[i % 3]}{chr(97 + i * j % 26)}é{j % 5}" for j in range(i % 40))) for i in range(300)]
    docs = spark.createDataFrame(texts, "id int, lang string, t string").repartition(3)

    def predicted():
        made = language.train(docs, "lang", "t")
        return sorted((r["id"] is None, r["id"], r["predicted"], round(r["confidence"], 9)) for r in language.predict(docs, ["id"], "t", made).collect())

    whole = predicted()
    assert len(whole) == 300 and len({r[2] for r in whole}) == 4
    for name, value in (("READ_CHARS", 50), ("FLUSH_GRAMS", 20), ("HELD_GRAMS", 30)):
        monkeypatch.setattr(language, name, value)
        assert predicted() == whole


def test_trigrams_are_counted_before_they_move(spark):
    """A row per gram, task and label leaves the tasks, not one per gram and text."""
    docs = spark.range(2000, numPartitions=2).selectExpr("'en' AS lang", "'der die das' AS t")
    got = language.label_grams(docs, "lang", "t")
    assert {r["gram"]: r["n"] for r in got.collect()}["der"] == 2000


def test_raw_texts_take_as_many_files_as_the_table_has_parts(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, f"text {i}") for i in range(240)], "doc_id long, text string").repartition(24).write.parquet(f"{tmp_path}/documents.parquet")
    seen, listed = [], audit_queries.files_source.raw_items
    monkeypatch.setattr(audit_queries.files_source, "raw_items", lambda *a: seen.append(listed(*a)) or seen[-1])
    for size, least in (("128m", 4), ("1k", 24)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            assert [tuple(r) for r in audit_queries.raw_pending(spark, str(tmp_path)).collect()] == [("text", 3, True)]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert seen[-1].count() >= least
