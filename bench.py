"""Bench: run every registered query over the tables at $BENCH_SF_DIR.

Each query is run to completion with the ``noop`` sink (every row computed,
nothing collected to the driver). One untimed pass over all queries warms
the JVM first; then each query's best of ``BENCH_RUNS`` runs is kept.
Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated subset), BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise.session import local_session  # noqa: E402
from shelfwise.plans.catalog import QUERIES  # noqa: E402


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=max(cpus, 8), app="shelfwise-bench")
    for n in names:                                    # warm-up pass, not timed
        QUERIES[n](spark, base).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for n in names:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[n](spark, base).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[n] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", base)
    sf = float(m.group(1)) if m else None
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
