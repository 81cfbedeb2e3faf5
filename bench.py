"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local cores. Each query runs once
to warm up and is then timed from building its plan to computing every result row.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starloom import session  # noqa: E402
from starloom.queries import QUERIES  # noqa: E402

HEADLINE = (
    "revenue_by_month_category",
    "fact_orders",
    "dim_customers",
    "dim_products",
    "dim_time",
    "surrogate_keys",
    "dq_report",
    "dq_duplicates",
    "constraint_report",
    "fk_orphans",
    "stage_order_items",
    "csv_scan",
    "full_load",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build_session(
        "starloom-bench", master=f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus}
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    result = {"metric": "headline_queries_total", "value": total, "unit": "sec"}
    print(json.dumps({**result, "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
