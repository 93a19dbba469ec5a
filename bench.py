"""Benchmark: run the queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver). Prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Every query over the job ledger is run; BENCH_QUERIES=a,b picks some. Queries
not begun after $BENCH_BUDGET_SEC (480) are listed as skipped; HEADLINE ones
come first.
Each query runs untimed on $BENCH_WARMUP_DIR (default sf0.01) first, so the timings are steady-state (JIT and codegen compiled);
BENCH_WARMUP=0 skips it and times cold runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "queue_stats", "job_metrics", "read_jobs", "enqueue_batch", "materialise_jobs", "apply_unique",
    "dispatch_per_queue", "retry_plan", "fetch_backoff", "worker_state", "state_timeline",
    "active_over_time", "ready_steps", "expand_workflows", "process", "rate_limit_rollup",
    "parse_error_responses", "stale_jobs", "stream_throughput", "to_execution_log",
    "submit_requests", "run_jobs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ["BENCH_CPUS"] = cpus
    from jobledger.catalog import QUERIES
    from jobledger.session import get_session

    spark = get_session(master=f"local[{cpus}]")
    names = os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else sorted(QUERIES)
    names.sort(key=lambda n: (n not in HEADLINE, n))
    # Each query runs once on the small scale (other files, same plan) before
    # it is timed: JIT and codegen compile then; reported, not timed.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    warm = warm_dir and os.path.isdir(warm_dir) and os.environ.get("BENCH_WARMUP", "1") == "1"
    times, skipped, warmup_sec = {}, [], 0.0
    began, budget = time.perf_counter(), float(os.environ.get("BENCH_BUDGET_SEC", "480"))

    def run(name, folder):
        t0 = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:
        if time.perf_counter() - began > budget:
            skipped.append(name)
            continue
        warmup_sec += run(name, warm_dir) if warm else 0.0
        times[name] = round(run(name, sf_dir), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "ledger_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "skipped": skipped, "warmup_sec": round(warmup_sec, 3), "warmup_dir": warm_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
