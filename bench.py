"""Seconds per registered query; prints one line of JSON.

BENCH_SF_DIR and BENCH_CPUS choose the input folder and the number of threads.
BENCH_RUNS is the number of timed runs after one untimed; the median counts.
BENCH_QUERIES may name some of the queries, separated by commas.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from codonmill.session import build_session  # noqa: E402
from harness.queries import QUERIES  # noqa: E402


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
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
    times = {}
    for name in names:
        seconds(QUERIES[name], spark, sf_dir)
        times[name] = round(
            statistics.median(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3
        )
    spark.stop()
    result = {
        "metric": "median seconds, summed over all queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
