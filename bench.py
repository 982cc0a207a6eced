"""Time the daily job and the registered queries; print one JSON line.

    BENCH_SF_DIR   sample tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads (default 8)
    BENCH_RUNS     timed runs of each query, of which the median counts (default 3)

``job_*`` are the steps that build the lake; every other entry is a registered query on that lake.
Everything is run once before it is timed. The job is timed once, on a new lake.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from registry import sample_lake as samples
from registry.queries import CITY, DAY, QUERIES
from roadbook.plans import job
from roadbook.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


# The steps of this one are the job_* entries.
TIMED_ABOVE = {"job_run"}


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    for _ in ("warm-up", "timed"):
        lake = samples.new_lake(spark)
        times["job_land_bronze"] = seconds(lambda: samples.land(spark, SF_DIR, lake))
        times["job_build_silver"] = seconds(lambda: job.build_silver(spark, lake))
        times["job_build_gold"] = seconds(lambda: job.build_gold(spark, lake))
    samples.remember(spark, SF_DIR, lake)

    for name, query in QUERIES.items():
        if name in TIMED_ABOVE:
            continue

        def run():
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()

        run()
        times[name] = statistics.median(seconds(run) for _ in range(RUNS))

    cost = job.cost_comparison(spark, lake, CITY, DAY).first()
    print(
        json.dumps(
            {
                "metric": "total time of the daily job and all registered queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": SF_DIR.rsplit("/sf", 1)[-1],
                "bytes_scanned_before": cost.before.bytes_scanned,
                "bytes_scanned_after": cost.after.bytes_scanned,
                "files_touched_before": cost.before.files_touched,
                "files_touched_after": cost.after.files_touched,
                "bytes_reduction_pct": cost.reduction_pct,
            }
        )
    )


if __name__ == "__main__":
    main()
