"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   test folder (default /root/testdata/sf0.1)
BENCH_CPUS     local executor threads (default 8)
BENCH_RUNS     measured runs per query after one warm-up (default 3, the median counts)
BENCH_QUERIES  comma-separated names (default: the headline list; "all" for every query)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from martlens.catalog.queries import QUERIES

HEADLINE = (
    "daily_revenue", "product_revenue", "campaign_metrics", "customer_enriched", "clv_tiers", "geo_targeting",
    "mta_touchpoints", "mta_touchpoints_customer", "mta_journeys", "attr_time_decay", "attr_summary", "attr_consensus",
    "mmm_contributions", "survey_weighted", "sv_multi_fact_kpi", "forecast_product_channel", "anomaly_order_counts",
    "review_sentiment", "review_extract", "channel_themes", "stream_daily_revenue",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    """Seconds to build and fully execute one query; rows go to Spark's no-op sink."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
