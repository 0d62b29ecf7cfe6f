"""Time the headline queries once each, after a warm-up of the session.

Environment: BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8), BENCH_ALL=1
for every registered query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costloom.plans import QUERIES  # noqa: E402
from costloom.session import local_session  # noqa: E402

HEADLINE = [
    "sales_pivot_by_month",
    "sales_fact",
    "line_margin",
    "business_mode",
    "current_vendor",
    "convert",
    "allocate_invoice_discount",
    "closest_invoice_line",
    "invoice_cost",
    "stock_by_invoices",
    "stock_reconciliation",
    "vendor_kpis",
    "month_end_valuation",
    "fifo_cost",
    "fifo_balance",
    "parse_feed",
    "upsert_products",
    "assign_brands",
    "scd2_prices",
    "apply_prices",
    "price_drops",
    "validate_sheet",
    "discount_violations",
    "historic_price",
    "cap_layer_cost",
    "lower_standard_price",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names[:1]:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
