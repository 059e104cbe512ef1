"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is run to completion with the ``noop`` sink (full execution, no
driver collect). A warm-up pass runs every query once on the same data set
(JIT-compiles the JSON and codegen paths, as in any long-running cluster
JVM) and is not timed; each query is then timed in $BENCH_REPEAT (default 3)
warm passes and its median is reported (single runs vary by about 30% here).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recurra import catalog  # noqa: E402
from recurra.session import build_session  # noqa: E402

HEADLINE = [
    "mrr_waterfall", "nrr_monthly", "mrr_current", "churn_rate", "failed_payment_rate",
    "reconciliation_totals", "reconciliation_iterations", "latest_subscription_version",
    "merchant_state", "consecutive_failures", "last_invoices_per_merchant",
    "cdc_normalise_subscriptions", "cdc_dead_letter", "billing_due", "retry_apply_invoices",
    "plan_change_apply", "snapshot_typed_subscriptions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or (HEADLINE if os.environ.get("BENCH_ALL") != "1" else list(catalog.QUERIES))
    spark = build_session(f"local[{cpus}]", app="recurra-bench", shuffle_partitions=int(cpus))
    def run(n, d=sf_dir):
        catalog.QUERIES[n](spark, d).write.format("noop").mode("overwrite").save()
    warm = os.environ.get("BENCH_WARM_DIR", sf_dir)
    for n in names:
        run(n, warm)
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    samples: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(repeat):
        for n in names:
            t0 = time.perf_counter()
            run(n)
            samples[n].append(time.perf_counter() - t0)
    times = {n: round(statistics.median(v), 3) for n, v in samples.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "timing": f"median of {repeat} warm passes, noop sink"}))
    spark.stop()


if __name__ == "__main__":
    main()
