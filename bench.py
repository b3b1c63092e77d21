"""Headline queries, timed end to end. Prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.queries import all_queries  # noqa: E402
from tallyloom.session import local_session  # noqa: E402

HEADLINE = [
    "stg_sales", "stg_inventory", "stg_target", "stg_sales_streaming", "stg_sales_unified",
    "dim_date", "dim_product", "dim_outlet", "fact_sales", "fact_inventory",
    "fact_sales_target", "run_ledger", "latest_versions", "skip_decisions",
    "current_raw_sales", "event_contract", "dlq_events", "dedup_events",
    "grain_violations_sales", "inventory_imbalance", "unique_violations", "orphans",
    "reconcile", "run_tests", "ingest_sales", "event_sink_state",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "12g"))
    queries = all_queries()
    queries["dim_product"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
        "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
