import duckdb
import pytest

import __spark_entry__ as entry
from corpuslab import catalog

SF = "/root/testdata/sf0.001"
CHECKED = ["publication_report", "url_canonical", "subtitle_cues", "theme_terms", "stage_counts", "folder_paths"]
PLANNED = [
    "publication_report", "theme_phrases", "timeline_week", "corpus_index", "url_canonical", "requeue_waterfall", "page_text",
    "subtitle_cues", "cue_word_offsets", "word_to_time", "repetition_runs", "window_hits", "keyword_research", "token_histogram",
    "completion", "orphans", "pareto_front", "trimmed_to_original", "item_set_gaps",
]


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 140


def test_entry(spark):
    assert entry.entry(spark).where("is_total = 1").count() == 1


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("nation", "region", "events", "documents", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cur = con.execute(catalog.SQL[name])
    names = [d[0] for d in cur.description]
    want = sorted(str({n: v for n, v in sorted(zip(names, row))}) for row in cur.fetchall())
    got = sorted(str({n: v for n, v in sorted(r.asDict().items())}) for r in catalog.QUERIES[name](spark, SF).collect())
    assert got == want and got


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_in_the_engine(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
