"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from corpuslab import catalog
from corpuslab.session import local_session

HEADLINE = [
    "publication_report", "incremental_records", "timeseries_csv", "theme_terms", "theme_phrases", "timeline_week",
    "emerging_terms", "corpus_index", "normalized_summaries", "url_canonical", "requeue_waterfall", "page_text",
    "frequent_lines", "subtitle_cues", "cue_word_offsets", "repetition_runs", "repetition_documents", "window_hits",
    "merged_hits", "cleaned_cues", "keyword_research", "language_predictions", "token_histogram", "completion",
    "orphans", "classification_metrics", "pareto_front", "folder_paths", "front_page", "trimmed_to_original",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "corpuslab-bench")
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["publication_frequency"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    only = os.environ.get("BENCH_ONLY")
    times: dict[str, float] = {}
    for name in only.split(",") if only else HEADLINE:
        start = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
