"""Times the headline queries: one JSON line, median of the warm runs of each.

BENCH_SF_DIR: folder of tables (default sf0.1); BENCH_CPUS: executor threads (default 8); BENCH_RUNS: warm runs (default 3).
Every result is written to Spark's `noop` sink, so that all rows and columns are made and none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from prospectra.plans.queries import QUERIES

HEADLINE = (
    "breakdown_by_state",
    "breakdown_by_category",
    "dashboard_stats",
    "outreach_by_day",
    "venue_contacts_summary",
    "action_needed",
    "top_picks",
    "gig_profile",
    "recommendations",
    "batch_funnel",
    "batch_selected",
    "category_canonical",
    "website_match",
    "quality_issues",
    "venue_duplicates",
    "contact_duplicates",
    "keyword_profile",
    "url_normalized",
    "page_links",
    "crawl_reachable",
    "step_summary",
    "log_sessions",
    "ledger_decisions",
    "snapshot_merge",
    "ext_tumbling",
    "ext_session",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(1 + int(os.environ.get("BENCH_RUNS", "3"))):
            began = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "sum of median warm seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
