"""Benchmark: wall seconds per registered query; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (timed runs per query, default 3; the median is reported),
BENCH_QUERIES (comma list; default all). Each query runs once untimed first.
Results are fully computed with the ``noop`` sink (nothing is collected).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import registry  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def _driver_memory() -> str:
    """BENCH_MEM if set, else about half the machine's memory, at most 16g."""
    if os.environ.get("BENCH_MEM"):
        return os.environ["BENCH_MEM"]
    try:
        with open("/proc/meminfo") as f:
            kb = int(next(x for x in f if x.startswith("MemTotal")).split()[1])
        return f"{max(1, min(16, kb // (2 * 1024 * 1024)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app="tidemark-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": _driver_memory(),
                                 # The tables are small: small splits use all cores.
                                 "spark.sql.files.maxPartitionBytes": "4m", "spark.sql.files.openCostInBytes": "64k"})
    qs = registry.queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(qs)
    times: dict[str, float] = {}
    for n in names:
        def run():
            t0 = time.perf_counter()
            qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        run()
        times[n] = round(statistics.median(run() for _ in range(repeat)), 3)
        print(f"# {n}: {times[n]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_median_query_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
