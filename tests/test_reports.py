"""The reports as text, held against texts written out by hand."""

import datetime as dt

import pytest

from corpuslab.plans import markdown, reports
from corpuslab.sources import files, writers

TERMS = "rank long, term string, score double, document_frequency long"
PHRASES = TERMS + ", channels array<string>"
BUCKETS = "bucket string, video_count long, channels map<string,long>, top_terms array<string>, top_phrases array<string>"
INDEX = "channel string, upload_date date, has_summary boolean"
VIDEOS = "term string, position int, title string, channel string, upload_date date, summary_md string"
DOCS = "doc_id long, channel string, title string, upload_date date, summary_md string, document string"


def text(lines):
    return "\n".join(r["line"] for r in lines.orderBy("pos").collect())


@pytest.fixture
def full(spark):
    docs = spark.range(3)
    terms = spark.createDataFrame([(2, "b|c", 0.25, 1), (1, "alpha", 1.5, 12)], TERMS)
    phrases = spark.createDataFrame([(1, "alpha beta", 0.5, 3, ["one", "t|wo"]), (2, "beta gamma", 0.25, 2, ["one"])], PHRASES)
    buckets = spark.createDataFrame(
        [("2024-W09", 1, {"one": 1}, [], []), ("2024-W08", 2, {"two": 1, "one": 1}, ["alpha", "beta"], ["alpha beta"])], BUCKETS
    )
    return docs, terms, phrases, buckets


def empty(spark):
    return spark.range(0), spark.createDataFrame([], TERMS), spark.createDataFrame([], PHRASES), spark.createDataFrame([], BUCKETS)


def test_themes_report(full):
    docs, terms, phrases, _ = full
    assert text(markdown.theme_lines(docs, terms, phrases, 30, "one")) == """# Themes Report

- Lookback days: 30
- Channel filter: one
- Videos considered: 3

## Top terms (TF-IDF)

| Rank | Term | Score | Videos |
|------|------|-------|--------|
| 1 | alpha | 1.500000 | 12 |
| 2 | b\\|c | 0.250000 | 1 |

## Top phrases

| Rank | Phrase | Doc frequency | Top channels |
|------|--------|---------------|--------------|
| 1 | alpha beta | 3 | one, t\\|wo |
| 2 | beta gamma | 2 | one |"""


def test_reports_of_nothing(spark):
    docs, terms, phrases, buckets = empty(spark)
    assert text(markdown.theme_lines(docs, terms, phrases, 7)) == """# Themes Report

- Lookback days: 7
- Channel filter: all channels
- Videos considered: 0

## Top terms (TF-IDF)

_No terms extracted._

## Top phrases

_No phrases met the document-frequency threshold._"""
    assert text(markdown.timeline_lines(docs, buckets, "month", 7)) == """# Timeline Report

- Lookback days: 7
- Channel filter: all channels
- Bucket type: month
- Videos considered: 0

_No videos in the lookback window._"""


def test_timeline_report(full):
    docs, _, _, buckets = full
    assert text(markdown.timeline_lines(docs, buckets, "week", 30)) == """# Timeline Report

- Lookback days: 30
- Channel filter: all channels
- Bucket type: week
- Videos considered: 3

## 2024-W08

- Videos: 2
- Channels: one (1), two (1)
- Top terms: alpha, beta
- Top phrases: alpha beta

## 2024-W09

- Videos: 1
- Channels: one (1)
- Top terms: none
- Top phrases: none"""


def test_digest(spark, full, tmp_path):
    docs, terms, phrases, buckets = full
    index = spark.createDataFrame([("one", dt.date(2024, 2, 20), True), ("two", None, False), ("two", dt.date(2024, 1, 2), False)], INDEX)
    videos = spark.createDataFrame(
        [("beta gamma", 1, "T3", "one", None, "s/3.md"), ("alpha beta", 2, "T2", "two", dt.date(2024, 2, 21), "s/2.md"),
         ("alpha beta", 1, "T1", "one", dt.date(2024, 2, 20), "s/1.md"), *[("beta gamma", i, f"U{i}", "one", None, "s") for i in range(2, 11)]],
        VIDEOS,
    )
    fresh, none = spark.createDataFrame([("z",), ("b",)], "term string"), spark.createDataFrame([], "term string")
    lines = markdown.digest_lines(index, docs, terms, phrases, videos, buckets, fresh, none, dt.date(2024, 3, 1), "2024-02-09", "week", 30)
    want = """# Research Digest

Generated: 2024-03-01

## Corpus Snapshot

- Videos indexed: 3
- With summaries: 1 (33.3%)
- Date range: 2024-01-02 — 2024-02-20
- Channels: 2

## Top Themes (last 30 days)

- Channel filter: all channels
- Videos considered: 3

### Top terms (TF-IDF)

| Rank | Term | Score | Videos |
|------|------|-------|--------|
| 1 | alpha | 1.500000 | 12 |
| 2 | b\\|c | 0.250000 | 1 |

### Top phrases

| Rank | Phrase | Doc frequency | Top channels |
|------|--------|---------------|--------------|
| 1 | alpha beta | 3 | one, t\\|wo |
| 2 | beta gamma | 2 | one |

## Timeline

### Week 2024-W08

- Videos: 2
- Top terms: alpha, beta

### Week 2024-W09

- Videos: 1
- Top terms: none

## Emerging (vs previous run)

- Previous run: 2024-02-09
- New terms: b, z
- New phrases: none

## Reading List

### alpha beta

1. **T1** — one, 2024-02-20 — `s/1.md`
2. **T2** — two, 2024-02-21 — `s/2.md`

### beta gamma

1. **T3** — one, unknown date — `s/3.md`
""" + "\n".join(f"{i}. **U{i}** — one, unknown date — `s`" for i in range(2, 11))
    assert text(lines) == want
    # written and read back: the same lines, empty ones too
    writers.write_lines(lines, str(tmp_path / "digest"))
    back = files.ordered_lines(spark, str(tmp_path / "digest"), ".txt").orderBy("position")
    assert "\n".join(r["line"] for r in back.collect()) == want


def test_first_digest_of_nothing(spark):
    index = spark.createDataFrame([], INDEX)
    docs = spark.createDataFrame([], DOCS)
    parts = reports.build_digest(index, docs, "doc_id", dt.date(2024, 3, 1), None, bucket="month", lookback_days=14, channel="x")
    assert text(parts["digest"]) == """# Research Digest

Generated: 2024-03-01

## Corpus Snapshot

- Videos indexed: 0
- With summaries: 0 (0.0%)
- Date range: unknown
- Channels: 0

## Top Themes (last 14 days)

- Channel filter: x
- Videos considered: 0

### Top terms (TF-IDF)

_No terms extracted._

### Top phrases

_No phrases met the document-frequency threshold._

## Timeline

_No videos in the lookback window._

## Emerging (vs previous run)

_First run — no previous snapshot._

## Reading List

_No phrases met the document-frequency threshold._"""


def test_former_run_is_checked_before_anything_is_written(spark, monkeypatch):
    def write(*_):
        raise AssertionError("written")

    monkeypatch.setattr(reports, "materialize", write)
    terms = spark.createDataFrame([("a",)], "term string")
    with pytest.raises(ValueError, match="phrases"):
        reports.build_digest(
            spark.createDataFrame([], INDEX), spark.createDataFrame([], DOCS), "doc_id", dt.date(2024, 3, 1),
            reports.Previous("2024-02-01", terms, terms.withColumnRenamed("term", "t")),
        )
