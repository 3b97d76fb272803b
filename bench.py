"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from ledgerflow.plans.registry import load
from ledgerflow.session import local_session

HEADLINE = [
    "s05_null_profile",
    "s06_outliers_lineitem",
    "c13_clean_invoices",
    "c14_clean_bank_movements",
    "t06_cash_flow_daily",
    "t06_cash_flow_daily_by_account",
    "t07_running_balance",
    "t14_prepare_forecasting",
    "f03_full_model",
    "f07_predict",
    "f07_predict_by_account",
    "f15_cross_validation",
    "e08_evaluation_report",
    "k06_kpi_row",
    "a03_net_by_year_month",
    "v07_all_rules",
    "v09_invoice_links",
    "v10_won_deal_followups",
    "v11_balance_breaks_across_accounts",
    "l05_check_all",
    "l10_anomalous_movements",
    "x01_stream_daily_flows",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("ledgerflow-bench")
    known = load()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs):
            start = time.perf_counter()
            known[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds), 3)
        print(f"{timings[name]:8.3f}s  {name}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_median_wall_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
