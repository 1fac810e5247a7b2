"""Write the executed (adaptive, final) physical plan of every report.

Usage: python tools/explain_all.py [sf_dir] > PLANS.md

Each query is run to completion first, so the adaptive plan shown is the
one that actually ran (broadcast vs shuffle join decided on real sizes).
Only the operator tree and the scan lines (ReadSchema, PushedFilters) are
kept.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

REPORTS = [
    "monthly_revenue", "top_products", "sales_cube", "cohort_retention", "monthly_average_ticket",
    "top_items_labelled", "monthly_revenue_label", "top_customers", "monthly_delivery_days",
    "best_worst_month", "validate_null_keys", "clean_order_items", "load_fact_sales",
]


def condensed(text: str) -> str:
    tree, details = text.split("\n\n", 1) if "\n\n" in text else (text, "")
    tree = tree.split("+- == Initial Plan ==")[0]
    keep = [ln for ln in details.splitlines() if re.match(r"^(ReadSchema|PushedFilters|Location)", ln)]
    return tree.rstrip() + "\n\n" + "\n".join(k for k in keep if not k.startswith("Location"))


def main() -> None:
    from starmart.registry import QUERIES
    from starmart.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    jvm = spark.sparkContext._jvm
    print(f"# Executed physical plans ({sf}, local[8], AQE on)\n")
    for name in REPORTS:
        df = QUERIES[name](spark, sf)
        df.collect()
        text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        print(f"## {name}\n\n```\n{condensed(text)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
