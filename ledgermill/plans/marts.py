"""Recurring-revenue, revenue, receivables, vendor and payroll marts.

Dimension joins carry no broadcast hint: the planner broadcasts a dimension
while its measured size is below the session threshold and otherwise uses a
shuffle join whose hot fact partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rpt_mrr(subscriptions: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per subscription with customer and product context."""
    c = customers.select("customer_id", "company_name", "segment", "region", F.col("customer_id").alias("known_customer"))
    p = products.select("product_id", "product_name", "product_category", F.col("product_id").alias("known_product"))
    return (
        subscriptions.join(c, "customer_id", "left")
        .join(p, "product_id", "left")
        .select(
            "subscription_id",
            "plan_name",
            "status",
            "account_lifecycle_stage",
            F.col("known_customer").alias("customer_id"),
            "company_name",
            "segment",
            "region",
            F.col("known_product").alias("product_id"),
            "product_name",
            "product_category",
            "mrr",
            "arr",
            "active_mrr_baseline",
            "lifetime_revenue_to_date",
            "start_date",
            "end_date",
            "start_month",
            "end_month",
            "start_year",
            "tenure_months",
            "days_until_renewal_or_expiration",
            "is_active",
            "is_churned",
        )
    )


def rpt_revenue_summary(invoices: DataFrame, customers: DataFrame, employees: DataFrame) -> DataFrame:
    """Paid revenue by month, customer, sales rep and invoice type.

    Lines are summed per month, customer id, rep id and type before the
    dimensions are joined, so the joins see the summary and not the lines. The
    second aggregation merges groups whose customer is unknown. An invoice
    belongs to one such group, so distinct invoice counts add up.
    """
    totals = (
        invoices.filter(F.col("invoice_status") == "PAID")
        .groupBy("invoice_month", "invoice_quarter", "invoice_year", "customer_id", "sales_rep_id", "invoice_type")
        .agg(
            F.countDistinct("invoice_id").alias("n_invoices"),
            F.sum("gross_amount").alias("gross"),
            F.count("gross_amount").alias("n_gross"),
            F.sum("line_discount_amount").alias("discounts"),
            F.sum("calculated_line_net_amount").alias("net"),
        )
    )
    c = customers.select("customer_id", "company_name", "segment", "region", F.col("customer_id").alias("known_customer"))
    e = employees.select(
        F.col("employee_id").alias("sales_rep_id"),
        F.col("full_name").alias("sales_rep_name"),
        F.col("employee_department").alias("sales_rep_department"),
    )
    gross = F.sum("gross")
    return (
        totals.join(c, "customer_id", "left")
        .join(e, "sales_rep_id", "left")
        .groupBy(
            "invoice_month",
            "invoice_quarter",
            "invoice_year",
            F.col("known_customer").alias("customer_id"),
            "company_name",
            "segment",
            "region",
            "sales_rep_id",
            "sales_rep_name",
            "sales_rep_department",
            "invoice_type",
        )
        .agg(
            F.sum("n_invoices").alias("invoice_count"),
            gross.cast("decimal(24,2)").alias("gross_revenue"),
            F.sum("discounts").cast("decimal(30,8)").alias("total_discounts"),
            F.sum("net").cast("decimal(30,8)").alias("net_revenue"),
            (gross.cast("double") / F.nullif(F.sum("n_gross"), F.lit(0))).alias("avg_invoice_amount"),
        )
    )


def rpt_ar_aging(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per invoice line with customer context and age band."""
    c = customers.select(
        "customer_id",
        "company_name",
        "segment",
        "region",
        "billing_email",
        "credit_limit",
        F.col("is_active").alias("customer_is_active"),
        F.col("customer_id").alias("known_customer"),
    )
    return invoices.join(c, "customer_id", "left").select(
        "invoice_id",
        "invoice_type",
        "invoice_date",
        "due_date",
        "invoice_status",
        "currency",
        "invoice_month",
        "invoice_quarter",
        "invoice_year",
        F.col("known_customer").alias("customer_id"),
        "company_name",
        "segment",
        "region",
        "billing_email",
        "credit_limit",
        "customer_is_active",
        "gross_amount",
        "invoice_header_total",
        F.col("calculated_line_net_amount").alias("net_amount"),
        F.col("line_discount_amount").alias("discount_amount"),
        "ar_aging_bucket",
        "days_past_due",
        "payment_term_days_window",
        "is_paid_invoice",
    )


def with_totals(rows: DataFrame, totals: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Join totals to rows on NULL-safe keys (row column -> totals column).

    Totals are aggregates joined back, not unordered windows: an aggregate combines on
    the map side, whereas a window would sort a whole hot group in one task.
    """
    match = [F.col(k).eqNullSafe(F.col(t)) for k, t in keys.items()]
    return rows.join(totals, match, "left").drop(*keys.values())


def rpt_opex_by_vendor(bills: DataFrame, vendors: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per bill with vendor and account context and monthly totals."""
    v = vendors.select(
        "vendor_id", "vendor_name", "vendor_category", "payment_terms_days", F.col("vendor_id").alias("known_vendor")
    )
    a = accounts.select(
        F.col("account_id").alias("expense_account_id"),
        F.col("account_id").alias("known_account"),
        F.col("account_code").alias("expense_account_code"),
        F.col("account_name").alias("expense_account_name"),
        F.col("account_subtype").alias("expense_account_subtype"),
    )
    rows = (
        bills.join(v, "vendor_id", "left")
        .join(a, "expense_account_id", "left")
        .select(
            "bill_month",
            "bill_quarter",
            "bill_year",
            F.col("known_vendor").alias("vendor_id"),
            "vendor_name",
            "vendor_category",
            "payment_terms_days",
            F.col("known_account").alias("expense_account_id"),
            "expense_account_code",
            "expense_account_name",
            "expense_account_subtype",
            "bill_id",
            "bill_date",
            "due_date",
            "status",
            "currency",
            "description",
            "amount",
            "is_paid",
            "is_overdue",
            "days_past_due",
        )
    )
    # Bills are summed once, by the ids on them; both totals roll up from those cells, with
    # unknown ids as NULL like in the rows.
    cells = bills.groupBy("bill_month", "vendor_id", "expense_account_id").agg(
        F.count("bill_id").alias("n"), F.sum("amount").alias("spend")
    )
    cells = (
        cells.join(v.select("vendor_id", "known_vendor"), "vendor_id", "left")
        .join(a.select("expense_account_id", "known_account"), "expense_account_id", "left")
        .withColumnRenamed("bill_month", "_month")
    )
    by_vendor = cells.groupBy("_month", "known_vendor").agg(
        F.sum("n").alias("bills_this_month_per_vendor"), F.sum("spend").alias("total_spend_this_month_per_vendor")
    )
    by_account = cells.groupBy("_month", "known_account").agg(F.sum("spend").alias("total_spend_this_month_per_account"))
    rows = with_totals(rows, by_vendor, {"bill_month": "_month", "vendor_id": "known_vendor"})
    return with_totals(rows, by_account, {"bill_month": "_month", "expense_account_id": "known_account"})


def rpt_payroll_burn(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    """One row per payroll row with employee context and monthly cost totals.

    Totals group by the department on the payroll row; the reported department
    is the employee's.
    """
    # One pass: pay per employee, rolled up to departments and those to months.
    per_employee = payroll.groupBy(F.col("pay_month").alias("_month"), F.col("department").alias("_department"), "employee_id").agg(
        F.sum("gross_pay").alias("gross")
    )
    by_department = per_employee.groupBy("_month", "_department").agg(
        F.sum("gross").alias("dept_gross_pay_this_month"), F.count("employee_id").alias("dept_headcount_this_month")
    )
    by_month = by_department.groupBy("_month").agg(F.sum("dept_gross_pay_this_month").alias("total_payroll_this_month"))
    totals = with_totals(by_department, by_month.withColumnRenamed("_month", "_of"), {"_month": "_of"})
    rows = with_totals(payroll, totals, {"pay_month": "_month", "department": "_department"})
    e = employees.select(
        "employee_id",
        F.col("employee_id").alias("known_employee"),
        "full_name",
        "employee_department",
        "employee_role",
        "manager_name",
        F.col("is_active").alias("employee_is_active"),
    )
    return rows.join(e, "employee_id", "left").select(
        "pay_month",
        "pay_quarter",
        "pay_year",
        "pay_period_start",
        "pay_period_end",
        "payment_date",
        F.col("known_employee").alias("employee_id"),
        "full_name",
        F.col("employee_department").alias("department"),
        F.col("employee_role").alias("role"),
        "manager_name",
        "employee_is_active",
        "pay_type",
        "is_salary",
        "is_bonus",
        "gross_pay",
        "tax_withheld",
        "net_pay",
        "effective_tax_rate",
        "dept_gross_pay_this_month",
        "dept_headcount_this_month",
        "total_payroll_this_month",
    )
