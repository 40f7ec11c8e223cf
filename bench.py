"""Benchmark: run the registered queries and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all), BENCH_REPEAT (default 1; the best
of N runs is reported). Each query is executed in full through the
``noop`` sink (every row computed, nothing collected to the driver).
A small warm-up query runs first so JIT start-up is not billed to q1.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))

    from stratum.session import local_session
    from stratum.plans.queries import QUERIES

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="stratum-bench")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)

    # warm-up on the smallest fixture (JIT, class loading, file listing cache)
    warm_dir = "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else sf_dir
    QUERIES["fct_revenue_by_city"](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in wanted:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
        print(f"# {name}: {times[name]:.3f}s", file=sys.stderr, flush=True)

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
