"""Times the warehouse loads and every dashboard query; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bazaarlake.plans import batch, dashboards, registry, star  # noqa: E402
from bazaarlake.session import local_session  # noqa: E402

OPERATORS = [
    "clean_orders",
    "clean_line_prices",
    "clean_user_data",
    "clean_order_merchant",
    "customer_source",
    "fact_lines_matched",
    "fact_as_of_versions",
    "fact_order_incoming",
    "scd_changes_customer",
    "integrity_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).count()
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("load_first", lambda: star.driver_star(spark, sf_dir, whole=True))
    timed("load_second", lambda: star.second_star(spark, sf_dir, whole=True))
    queries = registry.queries()
    for name in [*dashboards.QUERIES, *OPERATORS]:
        timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    print(
        json.dumps(
            {
                "metric": "warehouse loads and dashboard queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("/sf", 1)[-1],
                "tables": len(batch.DIMENSIONS) + 2,
            }
        )
    )


if __name__ == "__main__":
    main()
