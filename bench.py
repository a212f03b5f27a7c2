"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default all)
choose data and cores. ``build_warehouse`` is the whole ingest: ranking, credit
resolution, staging and writing the history. Reports then read the history;
their whole result is fetched.
"""

import json
import os
import tempfile
import time

from upcharts.plans.warehouse import warehouse
from upcharts.registry import QUERIES
from upcharts.session import build_session

HEADLINE = [
    "genre_climb",
    "genre_family_climb",
    "recurrence_summary",
    "trajectory_shape",
    "artist_recurrence",
    "genre_delta_robust",
    "genre_climb_robust",
    "genre_weekly_curve",
    "tag_clusters",
    "cohort_funnel",
    "staging_summary",
    "match_status",
]


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            # one machine: a folder of its own is shared by all that take part
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's readers and code generator outside the measurements
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count().collect()

    seconds = {"build_warehouse": timed(lambda: warehouse(spark, sf_dir))}
    for name in HEADLINE:
        seconds[name] = timed(lambda: QUERIES[name](spark, sf_dir).collect())
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
