"""Headline queries, timed warm; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [key ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

from contractlens.driver.catalog import QUERIES
from contractlens.session import local_session

HEADLINE = [
    "executive_summary", "monthly_base", "monthly_performance", "loss_bridge", "risk_scores", "driver_rank",
    "priority_score", "current_queue", "portfolio_snapshot", "before_after", "timeline", "measure_sum",
    "effective_dated_join", "asof_first", "asof_last", "scd2_merge", "replace_slice", "overlay_rules",
    "cost_from_template", "star_join", "multi_fact_left", "win_dup_count", "win_rank_global", "parse_decimal_br",
    "parse_datetime_br", "quarantine",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "contractlens-bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)  # warm-up: code generation and file cache
        seconds[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
