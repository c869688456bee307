"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS (default 3, the median counts) can be set; names on the
command line replace the headline set, `all` runs every query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemart.queries import QUERIES  # noqa: E402
from tidemart.session import build_session  # noqa: E402

HEADLINE = ["province_order_stats", "user_product_order_nd", "user_order_td_merge_join",
            "fact_page_view", "fact_login", "cart_top3_by_category", "user_retention",
            "comment_grade"]


def seconds(spark, name: str, folder: str) -> float:
    """Time of a full run, every column produced and none kept."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = list(QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINE
    spark = build_session("bench", {"spark.sql.shuffle.partitions": cpus,
                                    "spark.driver.memory": "16g"},
                          master=f"local[{cpus}]", log_level="ERROR")
    times = {}
    for name in names:
        seconds(spark, name, folder)  # warm-up
        times[name] = round(statistics.median(seconds(spark, name, folder)
                                              for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": folder.rsplit("sf", 1)[-1],
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
