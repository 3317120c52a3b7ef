"""Time every registered query and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2).
Each query runs once to warm up; the best of the following runs counts. Results go to the
no-op sink: every row and column is computed, none passes through the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from acervo.session import local_session  # noqa: E402
from acervo.workloads import all_queries  # noqa: E402


def run_once(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = sys.argv[1:]
    spark = local_session(cpus, shuffle_partitions=8, app="bench")
    seconds = {}
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        run_once(spark, query, sf_dir)
        seconds[name] = round(min(run_once(spark, query, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
