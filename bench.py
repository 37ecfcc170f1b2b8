"""Headline timings: one JSON line on stdout.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the local cores. Models that
others read are stored once per session; building each is timed as ``store_<model>`` and
counted in the total. Every query then runs in full, three times, into the no-op sink, and
its median counts. Two untimed reports warm the JVM first.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgermill.plans import catalog  # noqa: E402
from ledgermill.session import build_session  # noqa: E402

HEADLINE = [
    "build_journal",
    "gl_unbalanced_refs",
    "fact_invoices",
    "fact_journal_entries",
    "fact_payroll",
    "fact_subscriptions",
    "fact_vendor_bills",
    "rpt_pl_statement",
    "rpt_balance_sheet",
    "rpt_cash_flow",
    "rpt_mrr",
    "rpt_revenue_summary",
    "rpt_ar_aging",
    "rpt_opex_by_vendor",
    "rpt_payroll_burn",
    "kpis",
    "pnl",
    "revenue_by_rep",
    "ar_aging",
    "opex_vendor",
    "payroll",
    "billing_schedule",
    "annual_summary",
    "upsert",
    "dq_unique",
    "dq_not_null",
    "dq_orphans",
    "upsert_table",
    "materialize_incremental",
    "stream_upsert",
    "stream_late",
    "load_replace",
    "fact_invoices_bucketed",
    "subscriptions_on_days",
    "revenue_by_rep_bitmaps",
    "payroll_bitmaps",
]
# In the order in which they build on each other.
STORED = [
    "stg_chart_of_accounts",
    "stg_customers",
    "stg_products",
    "stg_vendors",
    "stg_subscriptions",
    "stg_invoices",
    "stg_invoice_lines",
    "stg_payments",
    "raw_employees",
    "raw_vendor_bills",
    "raw_payroll",
    "raw_journal_entries",
    "dim_accounts",
    "dim_customers",
    "dim_employees",
    "dim_products",
    "dim_vendors",
    "fact_invoices",
    "fact_journal_entries",
    "fact_payments",
    "fact_payroll",
    "fact_vendor_bills",
    "fact_subscriptions",
    "ledger_months",
    "rpt_pl_statement",
    "rpt_balance_sheet",
    "rpt_cash_flow",
    "rpt_mrr",
    "rpt_revenue_summary",
    "rpt_ar_aging",
    "rpt_opex_by_vendor",
    "rpt_payroll_burn",
    "revenue_bitmaps",
    "payroll_bitmaps",
]
RUNS = 3


WARM_UP = ["rpt_balance_sheet", "rpt_revenue_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        catalog.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    def build(name: str) -> float:
        models = catalog.Models(spark, sf_dir)
        started = time.perf_counter()
        if name in catalog.STAGED:
            models.stg(catalog.STAGED[name])
        else:
            getattr(models.raw if name.startswith("raw_") else models, name)
        return time.perf_counter() - started

    for name in WARM_UP:
        run(name)
    catalog.forget_stored()
    seconds = {f"store_{name}": round(build(name), 3) for name in STORED}
    seconds |= {name: round(statistics.median(run(name) for _ in range(RUNS)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
