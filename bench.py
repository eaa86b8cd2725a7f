"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from harness.queries import QUERIES
from skytally.session import build_session

HEADLINE = [
    "fleet_summary", "bi_kpis", "delays_by_operator", "top10_routes_volume", "weekday_share",
    "heatmap_pivot", "hist_features", "origin_point_join", "snapshot_insights", "flatten_routes",
    "region_flows_latest", "live_features", "serving_records", "business_kpis", "top_routes",
    "latest_flights", "search_flights_ilike", "free_text_search", "merge_documents",
    "merge_relational", "stratified_split_counts", "run_log_gauges", "stream_equals_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
