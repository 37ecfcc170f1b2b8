from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill.plans import marts, serving
from tests.conftest import as_set

INVOICE_LINES = (
    "invoice_month date, invoice_quarter date, invoice_year int, customer_id string, sales_rep_id string, invoice_type string, "
    "invoice_status string, invoice_id string, gross_amount decimal(15,2), line_discount_amount decimal(15,2), "
    "calculated_line_net_amount decimal(15,2)"
)


def _line(customer, invoice, gross, status="PAID"):
    return f"('2001-01-01', '2001-01-01', 2001, '{customer}', 'E1', 'SUBSCRIPTION', '{status}', '{invoice}', {gross}, 1, 2)"


def test_revenue_merges_unknown_customers_and_counts_invoices_once(rows):
    lines = rows(
        INVOICE_LINES,
        ", ".join([_line("C1", "I1", 10), _line("C1", "I1", 20), _line("C1", "I2", 30), _line("C8", "I3", 5), _line("C9", "I4", 7), _line("C1", "I5", 99, "OPEN"), _line("C1", "I6", "NULL")]),
    )
    customers = rows("customer_id string, company_name string, segment string, region string", "('C1', 'Acme', 'SMB', 'WEST')")
    employees = rows("employee_id string, full_name string, employee_department string", "('E1', 'Ann Lee', 'SALES')")
    got = marts.rpt_revenue_summary(lines, customers, employees)
    assert as_set(got, "customer_id", "invoice_count", "gross_revenue", "avg_invoice_amount", "sales_rep_name") == {
        ("C1", 3, Decimal("60.00"), 20.0, "Ann Lee"),
        (None, 2, Decimal("12.00"), 6.0, "Ann Lee"),
    }


def test_totals_join_null_keys_too(rows):
    df = rows("k string, v int", "('a', 1), ('a', 2), (NULL, 5), (NULL, 6)")
    totals = df.groupBy(F.col("k").alias("_k")).agg(F.sum("v").alias("s"))
    assert as_set(marts.with_totals(df, totals, {"k": "_k"})) == {("a", 1, 3), ("a", 2, 3), (None, 5, 11), (None, 6, 11)}


def test_group_totals_never_sort_a_group_in_one_task(models):
    for report in (models.rpt_opex_by_vendor, models.rpt_payroll_burn):
        assert "Window" not in report._jdf.queryExecution().executedPlan().toString()


def test_payroll_headcount_is_distinct_and_by_row_department(models):
    burn = models.rpt_payroll_burn
    december = burn.filter("pay_month = '2000-12-01'")
    sales = december.filter("department = 'SALES'")
    assert as_set(sales, "dept_headcount_this_month") == {(sales.select("employee_id").distinct().count(),)}
    assert sales.count() == 2 * sales.select("employee_id").distinct().count()


def test_unpaid_lines_equal_the_sum_of_the_aging_buckets(models):
    aging = models.rpt_ar_aging
    unpaid = aging.filter("NOT is_paid_invoice")
    buckets = serving.ar_aging(aging).agg(F.sum("invoice_count")).first()[0]
    assert buckets == unpaid.count()
    headers = aging.select("invoice_id", "ar_aging_bucket").distinct().groupBy("ar_aging_bucket").count()
    assert {r[0]: r[1] for r in headers.collect()} == {
        "Paid": 1126,
        "Current (Not Due)": 5,
        "1-30 Days Overdue": 4,
        "31-60 Days Overdue": 4,
        "61-90 Days Overdue": 7,
        "91+ Days Overdue": 354,
    }


def test_filters_and_columns_reach_the_scan(models):
    plan = serving.mrr_by_plan(models.rpt_mrr)._jdf.queryExecution().optimizedPlan().toString()
    assert "c_acctbal" not in plan.replace("Relation", "").split("Project")[0]
    physical = serving.payroll_annual(models.rpt_payroll_burn)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in physical and "props" not in physical


def test_records_are_text_dates(rows):
    got = serving.records(rows("d date, n int", "('2001-01-02', 1), (NULL, NULL)"))
    assert as_set(got) == {("2001-01-02", 1), (None, None)}


def test_top_reps_are_fifteen_with_a_stable_tie_break(spark):
    revenue = spark.range(40).selectExpr(
        "concat('rep', lpad(id, 2, '0')) AS sales_rep_name", "cast(100 AS decimal(24,2)) AS gross_revenue",
        "cast(1 AS decimal(24,2)) AS net_revenue", "'C' AS customer_id", "1 AS invoice_count",
    )
    names = [r.sales_rep_name for r in serving.revenue_by_rep(revenue).collect()]
    assert names == [f"rep{i:02d}" for i in range(15)]
