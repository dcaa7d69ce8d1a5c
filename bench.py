"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  Each query runs once to warm up and then
``BENCH_RUNS`` times to a sink that keeps nothing; the median counts.  Times include building the plan, and so
the size checks and the staged intermediate tables of the operators that have them.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from testbed.queries import QUERIES
from titlepulse.session import build_session

HEADLINE = [
    "s5_scan_by_source",
    "m2_upsert_engagement",
    "m3_upsert_reviews",
    "r2_capped_streams",
    "j3_title_dimension",
    "j11_engagement_daily",
    "j13_reviews",
    "j17_estimates",
    "g1_platform_trends",
    "g2_genre_trends",
    "g3_weekly_rollup",
    "g6_attention_trends",
    "g7_cohort_split",
    "g13_title_monthly",
    "g14_revenue_engagement",
    "q3_platform_share_change",
    "q10_biggest_spikes",
    "d3_signal_coverage",
]


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
