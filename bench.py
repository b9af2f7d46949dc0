"""Time the registered queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores; BENCH_QUERIES (names separated by commas)
narrows the run and BENCH_RUNS sets how many timed runs the median is taken from.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.plans.catalog import REGISTERED
from millrace.session import local_session, tune


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or list(REGISTERED)
    spark = tune(local_session(cores, shuffle_partitions=8, app="bench"))
    warm = str(Path(sf_dir).parent / "sf0.001")

    def execute(name: str, folder: str) -> None:
        REGISTERED[name](spark, folder).write.format("noop").mode("overwrite").save()

    if os.path.isdir(warm):
        for name in ("revenue_by_window", "ttl_status", "message_outcomes"):
            execute(name, warm)
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(timed(lambda: execute(name, sf_dir)) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    line = {
        "metric": "total seconds of all registered queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
