"""Serving queries over the report tables: one function per question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.columns import percent
from ledgermill.operators.bitmaps import bitmap_rollup, roll_up

CASH_NAME = "CASH AND CASH EQUIVALENTS"
TOP_N = 15


def _whole(col: Column, name: str) -> Column:
    return F.round(col, 0).alias(name)


def _total(column: str, name: str | None = None) -> Column:
    return _whole(F.sum(column), name or column)


def _mean(column: str, name: str) -> Column:
    return _whole(F.sum(column).cast("decimal(24,2)") / F.nullif(F.count(column), F.lit(0)), name)


def _when(condition: str, column: str) -> Column:
    return F.sum(F.when(F.col(condition), F.col(column)).otherwise(0))


def records(df: DataFrame) -> DataFrame:
    """Serving form of a result: dates and timestamps as yyyy-MM-dd text, NULL kept as NULL."""
    dated = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, dated) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def kpis(mrr: DataFrame) -> DataFrame:
    active, churned = F.count(F.when(F.col("is_active"), 1)), F.count(F.when(F.col("is_churned"), 1))
    return mrr.agg(
        _whole(_when("is_active", "mrr"), "current_mrr"),
        _whole(_when("is_active", "arr"), "current_arr"),
        active.alias("active_subs"),
        churned.alias("churned_subs"),
        percent(churned, F.count(F.lit(1)), 1).alias("churn_rate_pct"),
        _whole(_when("is_active", "mrr").cast("decimal(24,2)") / F.nullif(active, F.lit(0)), "avg_mrr_per_sub"),
    )


def kpis_gross_margin(pnl: DataFrame) -> DataFrame:
    """Revenue, cost of revenue and margin of the latest year; margin is NULL without revenue."""
    def of_type(kind: str, amount: Column) -> Column:
        return F.sum(F.when(F.col("account_type") == kind, amount).otherwise(0)).cast("decimal(24,2)")

    amount = F.col("signed_period_amount")
    by_year = pnl.groupBy("entry_year").agg(
        of_type("REVENUE", amount).alias("revenue"), of_type("COGS", F.abs(amount)).alias("cogs")
    )
    # Latest year first; the NULL year is never the latest.
    return (
        by_year.filter(F.col("entry_year").isNotNull())
        .orderBy(F.desc("entry_year"))
        .limit(1)
        .select(
            "entry_year",
            F.round("revenue", 0).alias("total_revenue"),
            F.round("cogs", 0).alias("total_cogs"),
            percent(F.col("revenue") - F.col("cogs"), F.col("revenue"), 1).alias("gross_margin_pct"),
        )
    )


def kpis_cash_balance(balance: DataFrame) -> DataFrame:
    """Closing cash of the last month, 0 without a cash account.

    A NULL month counts as the last one: it sorts after every real month in the
    running total, so its balance is the final one.
    """
    month = F.col("entry_month")
    latest = F.max_by("closing_balance", F.coalesce(month, F.lit("9999-12-31").cast("date")))
    return balance.filter(F.col("account_name") == CASH_NAME).agg(
        F.coalesce(latest, F.lit(0).cast("decimal(24,2)")).alias("cash_balance")
    )


def pnl(report: DataFrame) -> DataFrame:
    return (
        report.groupBy("entry_month", "entry_year", "account_type")
        .agg(_total("signed_period_amount", "amount"))
        .orderBy(F.asc_nulls_last("entry_month"), "account_type")
    )


def pnl_detail(report: DataFrame) -> DataFrame:
    return report.orderBy(F.asc_nulls_last("entry_month"), "account_type_sort_key", "account_name").select(
        "entry_month",
        "entry_year",
        "account_type",
        "account_subtype",
        "account_name",
        F.round("period_amount", 0).alias("period_amount"),
        F.round("signed_period_amount", 0).alias("signed_period_amount"),
        F.round("ytd_cumulative_amount", 0).alias("ytd_amount"),
        "mom_variance_pct",
        "yoy_variance_pct",
        F.round("pct_of_revenue", 1).alias("pct_of_revenue"),
    )


def mrr_trend(revenue: DataFrame) -> DataFrame:
    return (
        revenue.filter(F.col("invoice_type") == "SUBSCRIPTION")
        .groupBy("invoice_month", "invoice_year")
        .agg(_total("gross_revenue", "sub_revenue"), F.countDistinct("customer_id").alias("paying_customers"))
        .orderBy(F.asc_nulls_last("invoice_month"))
    )


def mrr_by_plan(mrr: DataFrame) -> DataFrame:
    return (
        mrr.filter("is_active")
        .groupBy("plan_name")
        .agg(F.count(F.lit(1)).alias("sub_count"), _total("mrr", "total_mrr"), _total("arr", "total_arr"))
        .orderBy(F.desc_nulls_first("total_arr"))
    )


def mrr_lifecycle(mrr: DataFrame) -> DataFrame:
    return (
        mrr.filter("is_active")
        .groupBy("account_lifecycle_stage")
        .agg(F.count(F.lit(1)).alias("sub_count"), _total("mrr", "total_mrr"))
        .orderBy(F.desc_nulls_first("total_mrr"))
    )


def revenue_by_segment(revenue: DataFrame) -> DataFrame:
    return (
        revenue.groupBy("segment", "invoice_type")
        .agg(_total("gross_revenue"), _total("net_revenue"), F.countDistinct("customer_id").alias("customer_count"))
        .orderBy(F.desc_nulls_first("gross_revenue"))
    )


def revenue_by_rep(revenue: DataFrame) -> DataFrame:
    """Top sales reps by gross revenue, names breaking ties."""
    return (
        revenue.groupBy("sales_rep_name")
        .agg(
            _total("gross_revenue"),
            _total("net_revenue"),
            F.countDistinct("customer_id").alias("customers"),
            F.sum("invoice_count").alias("invoices"),
        )
        .orderBy(F.desc_nulls_first("gross_revenue"), F.asc_nulls_last("sales_rep_name"))
        .limit(TOP_N)
    )


def revenue_monthly(revenue: DataFrame) -> DataFrame:
    return (
        revenue.groupBy("invoice_month", "invoice_type")
        .agg(_total("gross_revenue"))
        .orderBy(F.asc_nulls_last("invoice_month"), "invoice_type")
    )


def ar_aging(aging: DataFrame) -> DataFrame:
    return (
        aging.filter(~F.col("is_paid_invoice"))
        .groupBy("ar_aging_bucket")
        .agg(
            F.count(F.lit(1)).alias("invoice_count"),
            _total("gross_amount", "total_exposure"),
            _whole(F.avg("days_past_due"), "avg_days_past_due"),
        )
        .orderBy("avg_days_past_due")
    )


def ar_aging_by_segment(aging: DataFrame) -> DataFrame:
    return (
        aging.filter(~F.col("is_paid_invoice"))
        .groupBy("segment", "ar_aging_bucket")
        .agg(F.count(F.lit(1)).alias("invoice_count"), _total("gross_amount", "total_exposure"))
        .orderBy(F.asc_nulls_last("segment"), "ar_aging_bucket")
    )


def balance_sheet(balance: DataFrame) -> DataFrame:
    return (
        balance.groupBy("entry_month", "entry_year", "account_type", "bs_section", "section_sort_key")
        .agg(_total("closing_balance"))
        .orderBy(F.asc_nulls_last("entry_month"), "section_sort_key")
        .drop("section_sort_key")
    )


def balance_sheet_latest(balance: DataFrame) -> DataFrame:
    latest = balance.agg(F.max("entry_month")).scalar()
    return (
        balance.filter(F.col("entry_month") == latest)
        .orderBy("section_sort_key", "account_name")
        .select(
            "account_type",
            "account_subtype",
            "account_name",
            "bs_section",
            F.round("closing_balance", 0).alias("closing_balance"),
        )
    )


def cash_flow(flow: DataFrame) -> DataFrame:
    return flow.orderBy(F.asc_nulls_last("entry_month"), "category_sort_key", "transaction_type").select(
        "entry_month",
        "entry_year",
        "cash_flow_category",
        "category_sort_key",
        F.round("total_cash_inflow", 0).alias("total_inflow"),
        F.round("total_cash_outflow", 0).alias("total_outflow"),
        F.round("net_cash_movement", 0).alias("net_movement"),
        F.round("cumulative_cash_balance", 0).alias("cumulative_balance"),
    )


def cash_flow_summary(flow: DataFrame) -> DataFrame:
    return (
        flow.groupBy("entry_year", "cash_flow_category")
        .agg(_total("net_cash_movement", "net_movement"))
        .orderBy(F.asc_nulls_last("entry_year"), "cash_flow_category")
    )


def opex_vendor(opex: DataFrame) -> DataFrame:
    """Top vendors by total spend, names breaking ties."""
    names = ["vendor_name", "vendor_category", "expense_account_name"]
    return (
        opex.groupBy(*names)
        .agg(
            _total("amount", "total_spend"),
            F.count(F.lit(1)).alias("bill_count"),
            _mean("amount", "avg_monthly_spend"),
        )
        .orderBy(F.desc_nulls_first("total_spend"), *[F.asc_nulls_last(n) for n in names])
        .limit(TOP_N)
    )


def opex_vendor_monthly(opex: DataFrame) -> DataFrame:
    return (
        opex.groupBy("bill_month", "bill_year", "vendor_category")
        .agg(_total("amount", "total_spend"))
        .orderBy(F.asc_nulls_last("bill_month"), "vendor_category")
    )


def payroll(burn: DataFrame) -> DataFrame:
    return (
        burn.groupBy("pay_month", "pay_year", "department", "pay_type")
        .agg(
            _total("gross_pay"),
            _total("tax_withheld"),
            _total("net_pay"),
            F.countDistinct("employee_id").alias("headcount"),
        )
        .orderBy(F.asc_nulls_last("pay_month"), "department", "pay_type")
    )


def payroll_annual(burn: DataFrame) -> DataFrame:
    return (
        burn.groupBy("pay_year", "department", "pay_type")
        .agg(_total("gross_pay"), F.countDistinct("employee_id").alias("headcount"))
        .orderBy(F.asc_nulls_last("pay_year"), "department", "pay_type")
    )


# -- distinct counts from stored bitmaps ----------------------------------------------


def revenue_bitmaps(revenue: DataFrame, customer_ids: DataFrame) -> DataFrame:
    """The paying customers of every month, type, segment and rep as bitmaps, with the revenue."""
    grain = ["invoice_month", "invoice_year", "invoice_type", "segment", "sales_rep_name"]
    return bitmap_rollup(revenue, grain, customer_ids, "customer_id", ["gross_revenue", "net_revenue", "invoice_count"])


def payroll_bitmaps(burn: DataFrame, employee_ids: DataFrame) -> DataFrame:
    """The employees paid in every month, department and pay type as bitmaps, with the pay."""
    grain = ["pay_month", "pay_year", "department", "pay_type"]
    return bitmap_rollup(burn, grain, employee_ids, "employee_id", ["gross_pay", "tax_withheld", "net_pay"])


def mrr_trend_rolled(bitmaps: DataFrame) -> DataFrame:
    """``mrr_trend`` from the stored bitmaps."""
    months = roll_up(
        bitmaps.filter(F.col("invoice_type") == "SUBSCRIPTION"), ["invoice_month", "invoice_year"], "paying_customers", ["gross_revenue"]
    )
    return months.select("invoice_month", "invoice_year", _whole(F.col("gross_revenue"), "sub_revenue"), "paying_customers").orderBy(
        F.asc_nulls_last("invoice_month")
    )


def revenue_by_segment_rolled(bitmaps: DataFrame) -> DataFrame:
    """``revenue_by_segment`` from the stored bitmaps."""
    found = roll_up(bitmaps, ["segment", "invoice_type"], "customer_count", ["gross_revenue", "net_revenue"])
    money = [_whole(F.col(c), c) for c in ("gross_revenue", "net_revenue")]
    return found.select("segment", "invoice_type", *money, "customer_count").orderBy(F.desc_nulls_first("gross_revenue"))


def revenue_by_rep_rolled(bitmaps: DataFrame) -> DataFrame:
    """``revenue_by_rep`` from the stored bitmaps."""
    found = roll_up(bitmaps, ["sales_rep_name"], "customers", ["gross_revenue", "net_revenue", "invoice_count"])
    money = [_whole(F.col(c), c) for c in ("gross_revenue", "net_revenue")]
    return (
        found.select("sales_rep_name", *money, "customers", F.col("invoice_count").alias("invoices"))
        .orderBy(F.desc_nulls_first("gross_revenue"), F.asc_nulls_last("sales_rep_name"))
        .limit(TOP_N)
    )


def payroll_rolled(bitmaps: DataFrame) -> DataFrame:
    """``payroll`` from the stored bitmaps."""
    grain, money = ["pay_month", "pay_year", "department", "pay_type"], ["gross_pay", "tax_withheld", "net_pay"]
    found = roll_up(bitmaps, grain, "headcount", money)
    return found.select(*grain, *[_whole(F.col(c), c) for c in money], "headcount").orderBy(
        F.asc_nulls_last("pay_month"), "department", "pay_type"
    )


def payroll_annual_rolled(bitmaps: DataFrame) -> DataFrame:
    """``payroll_annual`` from the stored bitmaps."""
    grain = ["pay_year", "department", "pay_type"]
    found = roll_up(bitmaps, grain, "headcount", ["gross_pay"])
    return found.select(*grain, _whole(F.col("gross_pay"), "gross_pay"), "headcount").orderBy(
        F.asc_nulls_last("pay_year"), "department", "pay_type"
    )
