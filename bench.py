"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` picks the data, ``BENCH_CPUS`` the cores. The index is built first, and its time
given as ``index_build``. Then every query runs once to warm up and ``RUNS`` times on the clock, into Spark's no-op
sink; its time is the median of those. ``first`` holds the times of the first runs.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from starweave.session import local_session
from workload.queries import QUERIES
from workload.sky import index_path

RUNS = 3
HEADLINE = (
    "crossmatch_nearest",
    "crossmatch_wide_radius",
    "wide_pivot_v3",
    "star_left_attach",
    "spoke_anti_unmatched",
    "pair_join",
    "galaxies_adapter",
    "stream_page",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def timed(run) -> float:
        start = time.perf_counter()
        run()
        return round(time.perf_counter() - start, 3)

    built = timed(lambda: index_path(spark, sf_dir))
    seconds, first = {}, {}
    for name in HEADLINE:
        runs = [timed(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()) for _ in range(1 + RUNS)]
        first[name], seconds[name] = runs[0], median(runs[1:])
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first": first,
                "index_build": built,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
