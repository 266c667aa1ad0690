"""Time the registered queries: one JSON line on standard output.

``BENCH_SF_DIR`` is the folder of test tables, ``BENCH_CPUS`` the number of local cores,
``BENCH_RUNS`` how often each query is timed after a warm-up, ``BENCH_QUERIES`` a
comma-separated choice. Every run is a whole one, writes included; nothing is kept between
runs. The value is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import pathlib
import statistics
import time

from lakestar.plans.queries import QUERIES
from lakestar.session import local_session

HEADLINE = (
    "silver_clean",
    "dim_customer",
    "fact_sales",
    "sales_by_category_year",
    "dim_customer_upsert",
    "fact_incremental_total",
)


def seconds(spark, folder: str, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    timed = {}
    for name in names:
        seconds(spark, folder, name)
        timed[name] = round(statistics.median(seconds(spark, folder, name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": pathlib.Path(folder).name.removeprefix("sf"),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
