"""Headline queries, timed.

Prints one JSON line.  Every query runs in full (all partitions, all columns) into Spark's no-op
sink; the reported time is the best of three runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.catalogue.all import REGISTRY  # noqa: E402
from tillroll.session import builder  # noqa: E402

HEADLINES = (
    "r01_top_articles",
    "r02_top_by_store_and_direction",
    "r03_flight_revenue",
    "r05_compared_by_article",
    "r09_revenue_last_sold",
    "r10_channel_other",
    "r11_year_report",
    "r13_campaign_profitability",
    "r20_sales_by_leaf",
    "r21_across_chains_monthly",
    "r35_sales_extract",
    "r37_count_against_book",
    "r39_revenue_by_week",
    "r45_pick_times",
    "r54_settlement_revision",
    "r56_account_lines",
    "r58_bank_against_register",
    "r61_cash_settlement",
    "r63_reconciliation_with_bag",
    "r65_reconciliation_details",
    "r78_reconciliation_by_till",
    "r84_key_figures_with_bags",
    "r85_returns_by_cashier",
    "s07_report_lines",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("tillroll-bench").master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINES:
        runs = []
        for _ in range(3):
            started = time.perf_counter()
            REGISTRY[name](spark, directory).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        times[name] = round(min(runs), 3)
    scale = os.path.basename(directory.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
