"""Yearly summaries over the raw and posted tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.columns import percent

# The two revenue lines of the annual summary, and cost-of-revenue accounts.
SUBSCRIPTION, SERVICES = "Subscription", "Professional Services"
VENDOR_COGS = ["5000", "5100", "5200"]
PAYROLL_COGS = "5300"


def _zero(col: str | Column) -> Column:
    return F.coalesce(col, F.lit(0).cast("decimal(25,2)"))


def revenue_by_year_type(invoices: DataFrame) -> DataFrame:
    """Invoice totals per year with one column per invoice type there is, 0 where a year has none.

    Totals per year and type come first; the types (a column each) are read off those few
    rows and matched by position, so a type may have any text; a column is named by it. A
    missing type has the column ``null``, and a name that is taken in any case of letters,
    ``year`` first, gets a number.
    """
    totals = invoices.groupBy(F.year("invoice_date").alias("year"), "invoice_type").agg(F.sum("total_amount").alias("total"))
    kinds = [r[0] for r in totals.select("invoice_type").distinct().orderBy(F.col("invoice_type").asc_nulls_last()).collect()]
    taken, columns = {"year"}, []
    for kind in kinds:
        name = text = "null" if kind is None else kind
        number = 2
        while name.lower() in taken:
            name, number = f"{text}_{number}", number + 1
        taken.add(name.lower())
        same = F.col("invoice_type").eqNullSafe(F.lit(kind).cast("string"))
        columns.append(_zero(F.sum(F.when(same, F.col("total")))).alias(name))
    return totals.groupBy("year").agg(*columns) if columns else totals.select("year")


def revenue_lines_by_year(invoices: DataFrame) -> DataFrame:
    """Invoice totals per year of the two revenue lines that the annual summary reports."""

    def line(kind: str, name: str) -> Column:
        return _zero(F.sum(F.when(F.col("invoice_type") == kind, F.col("total_amount")))).alias(name)

    return invoices.groupBy(F.year("invoice_date").alias("year")).agg(
        line(SUBSCRIPTION, "subscription"), line(SERVICES, "professional_services")
    )


def payroll_by_year(payroll: DataFrame) -> DataFrame:
    return payroll.groupBy(F.year("pay_period_start").alias("year")).agg(F.sum("gross_pay").alias("gross_pay"))


def vendor_spend_by_year(bills: DataFrame) -> DataFrame:
    return bills.groupBy(F.year("bill_date").alias("year")).agg(F.sum("amount").alias("vendor_spend"))


def active_subs_at_year_end(subscriptions: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Subscriptions running on 31 December of every year in the range.

    Each subscription adds one in its start year and takes one away in its end
    year (a subscription ending on 31 December no longer counts); yearly changes
    are summed first and accumulated over that handful of rows, so there is no
    range join between years and subscriptions.
    """
    start = F.year("start_date")
    change = F.array(
        F.struct(start.alias("year"), F.lit(1).alias("n")),
        F.struct(F.greatest(start, F.year("end_date")).alias("year"), F.lit(-1).alias("n")),
    )
    steps = (
        subscriptions.filter(F.col("start_date").isNotNull())
        .select(F.inline(F.when(F.col("end_date").isNull(), F.slice(change, 1, 1)).otherwise(change)))
        .filter(F.col("year") <= last_year)
        .groupBy(F.greatest("year", F.lit(first_year)).alias("year"))
        .agg(F.sum("n").alias("n"))
    )
    years = subscriptions.sparkSession.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    to_date = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        years.join(steps, "year", "left")
        .select("year", F.sum(F.coalesce("n", F.lit(0))).over(to_date).cast("long").alias("active_subs"))
    )


def cogs_by_year(journal: DataFrame) -> DataFrame:
    """Debits on the cost-of-revenue accounts, split into vendor and payroll cost."""
    is_payroll = F.col("account_code") == PAYROLL_COGS
    return (
        journal.filter(F.col("account_code").isin(*VENDOR_COGS, PAYROLL_COGS))
        .groupBy(F.year("entry_date").alias("year"))
        .agg(
            F.sum("debit_amount").alias("cogs"),
            _zero(F.sum(F.when(~is_payroll, F.col("debit_amount")))).alias("vendor_cogs"),
            _zero(F.sum(F.when(is_payroll, F.col("debit_amount")))).alias("payroll_cogs"),
        )
    )


def annual_summary(
    invoices: DataFrame,
    payroll: DataFrame,
    bills: DataFrame,
    subscriptions: DataFrame,
    journal: DataFrame,
    first_year: int,
    last_year: int,
) -> DataFrame:
    """Revenue, cost, margin, operating cost, net and active subscriptions per year.

    Cost of revenue is split out of payroll and vendor spend by the journal's
    cost-of-revenue accounts. Every input is reduced to one row per year before
    the rows meet.
    """
    parts = [
        revenue_lines_by_year(invoices),
        cogs_by_year(journal),
        payroll_by_year(payroll),
        vendor_spend_by_year(bills),
    ]
    years = active_subs_at_year_end(subscriptions, first_year, last_year)
    wide = reduce(lambda left, right: left.join(right, "year", "left"), parts, years)
    revenue = _zero("subscription") + _zero("professional_services")
    profit = F.col("total_revenue") - F.col("cogs")
    return (
        wide.select(
            "year",
            _zero("subscription").alias("subscription_revenue"),
            _zero("professional_services").alias("services_revenue"),
            revenue.alias("total_revenue"),
            _zero("cogs").alias("cogs"),
            (_zero("gross_pay") - _zero("payroll_cogs")).alias("payroll_opex"),
            (_zero("vendor_spend") - _zero("vendor_cogs")).alias("vendor_opex"),
            "active_subs",
        )
        .withColumn("gross_profit", profit)
        .withColumn("gross_margin_pct", F.coalesce(percent(profit, F.col("total_revenue"), 1), F.lit(0).cast("decimal(10,1)")))
        .withColumn("net", F.col("gross_profit") - F.col("payroll_opex") - F.col("vendor_opex"))
    )


def churn_summary(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions whose status is exactly Churned, out of all."""
    churned = F.count(F.when(F.col("status") == "Churned", 1))
    total = F.count(F.lit(1))
    return subscriptions.agg(churned.alias("churned"), total.alias("total")).withColumn(
        "churn_pct", percent(F.col("churned"), F.col("total"), 1)
    )
