"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (test tables), BENCH_CPUS (threads), BENCH_QUERIES (names, comma separated).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.queries import REGISTRY

HEADLINE = (
    "inventory_position", "inventory_levels", "stock_movements", "stock_or_join", "stock_by_category", "stock_kpis",
    "cash_requirements", "weekly_cash_flow", "cash_project_pivot", "po_lines", "open_po_summary", "po_stats",
    "vendor_bills", "bills_unpaid", "bill_stats", "project_tasks", "project_hierarchy", "project_summary", "plan_stats",
    "on_site_now", "week_overtime", "attendance_sessions", "attendance_json", "message_search", "search_digest",
    "clean_html_notes", "clean_text_squash", "explore_page", "explore_deep_page", "top_groups", "dataset_health",
    "log_errors",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        # The test tables are small: partitions of less than a megabyte still deserve a core each.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    REGISTRY["json_props"](spark, folder).write.format("noop").mode("overwrite").save()  # start the engine
    times = {}
    for name in names:
        start = time.perf_counter()
        # Every column of the result is computed; a count would let Spark skip most of them.
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
