"""Benchmark of the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of the test tables, BENCH_CPUS the number of local threads and
BENCH_RUNS the number of timed runs, of which the best counts. One run before them warms
up. A time covers building the query and computing all of its rows.
"""

from __future__ import annotations

import json
import os
import time

from tillscope.registered import QUERIES
from tillscope.session import build_session

HEADLINE = [
    "top_categories",
    "top_products",
    "top_products_per_category",
    "top_ips",
    "top_ip_countries",
    "top_countries",
    "top_countries_longest",
    "geo_join_inclusive",
    "geo_join_longest",
    "category_self_join",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        query = QUERIES[name]
        run(query, spark, sf_dir)
        times[name] = round(min(run(query, spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
