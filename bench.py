"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query runs twice in full; the second run is reported, so the figures do not
hold the JVM's and the Python workers' start. `cold` holds the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from acervo.plans import QUERIES  # noqa: E402
from acervo.session import build_session, ship_package  # noqa: E402

HEADLINE = [
    "q03_marker_filter", "q05_manifest_anti", "q06_status_merge", "q07_lookup_defaults", "q08_duplicate_keys", "q09_links",
    "q11_page_text", "q14_slug_id", "q16_br_dates", "q18_money", "q19_relevance", "q24_carry_forward", "q25_systematic_sample",
    "q26_paging_stop", "q28_alias_scan", "q29_alias_fuzzy", "q30_similar_pairs", "q31_leader_clusters", "q34_keyword_pages",
    "q36_feed_first_wins", "q39_block_match", "q48_topic_parse", "q51_enriched", "q56_rating_actions", "q61_capture",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    ship_package()
    spark = build_session("acervo-bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    cold: dict[str, float] = {}
    seconds: dict[str, float] = {}
    for name in names:
        for result in (cold, seconds):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            result[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "cold": cold, "sf": os.path.basename(os.path.normpath(sf_dir)),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
