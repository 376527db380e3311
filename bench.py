"""Wall time per headline query, median of three runs. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from lockscope.plans import QUERIES
from lockscope.session import build_session

HEADLINE = (
    "lock_artifacts",
    "lock_npm",
    "lock_npm_v1",
    "lock_yarn",
    "lock_pnpm",
    "lock_bun",
    "lock_all",
    "install_commands",
    "protocol_mix",
    "global_dedup",
    "dedup_metrics",
    "dedup_savings",
    "sri_verify",
    "blob_audit",
    "best_candidate",
    "url_ladder",
    "url_rewrite",
    "policy_groups",
    "cache_coverage",
    "stale_items",
    "composite_lookup",
    "batch_assign_hot",
    "percentile_hot",
    "timing_summary",
    "log_class",
    "failure_counts",
    "status_rollup",
    "run_summary",
    "ordered_output",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
