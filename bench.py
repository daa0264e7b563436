"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsgrid.plans import QUERIES  # noqa: E402
from newsgrid.session import local_session  # noqa: E402

HEADLINE = [
    "canonical_url", "strip_html", "dedupe_best", "pool_merge", "normalize_items", "incremental_anti_join", "snippet_join",
    "entity_extract", "keyword_category", "alias_tag_join", "weighted_score", "enrich", "top_feed", "feed_search", "facet_values",
    "cluster_rollup", "leader_cluster", "baseline_match_join", "series_upsert", "tiered_merge", "provider_fallback",
    "day_over_day_check", "unit_convert", "conflict_report", "dq_clustered", "dq_enriched", "health_rollup", "rss_items",
    "html_price_rows", "disclosed_average_extract", "page_scan_stop", "stream_latest_quote",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "newsgrid-bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["count_by_source"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the executors
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {times[name]:8.3f}", file=sys.stderr, flush=True)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times}
    print(json.dumps({**out, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
