"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Each query runs once to
warm up and once for the clock; every output column is computed and then dropped.
"""

from __future__ import annotations

import json
import os
import time

from emiscope.plans.catalog import QUERIES
from emiscope.session import build_session

HEADLINE = (
    "gold_latest_per_model",
    "dedup_last_wins",
    "discovery_rows",
    "enriched_rows",
    "gold_models",
    "bronze_card_rows",
    "shard_range_join",
    "count_by_shard",
    "chunk_assignment",
    "chunk_boundaries",
    "batch_numbers",
    "rate_window_plan",
    "page_running_totals",
    "flush_segments",
    "quantile_shards",
    "partition_metrics",
    "dataset_usage",
    "gold_with_dataset_sizes",
    "availability_profile",
    "job_prepare",
    "job_gold",
    "job_enrich",
    "job_bronze",
    "many_ranges_join",
    "rate_window_audit",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
