"""Billing and payroll schedules over given subscriptions, milestones and employees.

Schedules expand each row by an array of dates with ``explode``; nothing is
joined to a calendar, so expansion is a narrow step on the input's partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MONEY = "decimal(15,2)"
NET_DAYS = 30
BONUS_SHARE, BONUS_TAX = "0.25", "0.37"


def _day(value: str | Column) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def month_starts(first: Column, last: Column) -> Column:
    """First days of the months from ``first``'s month through ``last``; empty when last is earlier."""
    begin = F.trunc(first, "month")
    return F.when(begin <= last, F.sequence(begin, last, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )


def billing_schedule(subscriptions: DataFrame, period_start: str, period_end: str) -> DataFrame:
    """One invoice per subscription on the first of every active month, due 30 days later."""
    first = F.greatest(F.trunc("start_date", "month"), F.trunc(_day(period_start), "month"))
    last = F.least(F.coalesce("end_date", _day(period_end)), _day(period_end))
    return (
        subscriptions.withColumn("invoice_date", F.explode(month_starts(first, last)))
        .withColumn("label", F.date_format("invoice_date", "MMMM yyyy"))
        .select(
            F.concat("subscription_id", F.lit("-"), F.date_format("invoice_date", "yyyyMM")).alias("invoice_id"),
            "customer_id",
            "subscription_id",
            "product_id",
            F.lit("Subscription").alias("invoice_type"),
            "invoice_date",
            F.date_add("invoice_date", NET_DAYS).alias("due_date"),
            F.col("mrr").alias("total_amount"),
            F.concat("plan_name", F.lit(" -- "), "label").alias("description"),
            "label",
            F.col("invoice_date").alias("created_at"),
        )
    )


def invoice_lines_from_schedule(schedule: DataFrame) -> DataFrame:
    """The single full-price line of each scheduled invoice."""
    return schedule.select(
        F.concat("invoice_id", F.lit("-1")).alias("line_id"),
        "invoice_id",
        "product_id",
        "description",
        F.lit(1).alias("quantity"),
        F.col("total_amount").alias("unit_price"),
        F.lit(0).cast("decimal(6,4)").alias("discount_pct"),
        F.col("total_amount").alias("line_total"),
    )


def one_off_invoices(milestones: DataFrame, products: DataFrame) -> DataFrame:
    """Milestone orders priced at list: header and line columns of a one-line invoice."""
    priced = milestones.join(products.select("product_id", "unit_price"), "product_id")
    total = F.round(F.col("quantity") * F.col("unit_price"), 2).cast(MONEY)
    return priced.select(
        F.concat(F.lit("M"), "milestone_id").alias("invoice_id"),
        "customer_id",
        F.lit(None).cast("string").alias("subscription_id"),
        F.lit("Professional Services").alias("invoice_type"),
        F.col("milestone_date").alias("invoice_date"),
        F.date_add("milestone_date", NET_DAYS).alias("due_date"),
        total.alias("total_amount"),
        F.concat(F.lit("M"), "milestone_id", F.lit("-1")).alias("line_id"),
        "product_id",
        "quantity",
        "unit_price",
        F.lit(0).cast("decimal(6,4)").alias("discount_pct"),
        total.alias("line_total"),
    )


def close_out_subscriptions(subscriptions: DataFrame, churned: DataFrame, period_end: str) -> DataFrame:
    """Set status, end date and update date from the churned subscriptions (id, churn_date)."""
    found = F.col("churn_date").isNotNull()
    closed = subscriptions.join(churned.select("subscription_id", "churn_date"), "subscription_id", "left")
    return closed.select(
        *[
            F.when(found, "Churned").otherwise("Active").alias(c)
            if c == "status"
            else F.col("churn_date").alias(c)
            if c == "end_date"
            else F.coalesce("churn_date", _day(period_end)).alias(c)
            if c == "updated_at"
            else F.col(c)
            for c in subscriptions.columns
        ]
    )


def payroll_schedule(employees: DataFrame, first_year: int, last_year: int, raise_rate: str, tax_rate: str) -> DataFrame:
    """Monthly salary rows with a yearly compounding raise; rates are columns.

    Annual and monthly pay are rounded to cents in turn, tax and net pay after
    them; pay day is two days after the period ends.
    """
    months = F.sequence(
        F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
        F.make_date(F.lit(last_year), F.lit(12), F.lit(1)),
        F.expr("interval 1 month"),
    )
    years = F.year("m") - first_year
    factor = F.pow(1 + F.col(raise_rate).cast("double"), years)
    annual = F.round((F.col("salary").cast("double") * factor).cast("decimal(24,8)"), 2)
    tax = F.round(F.col("gross_pay") * F.col(tax_rate), 2).cast(MONEY)
    return (
        employees.withColumn("m", F.explode(months))
        .withColumn("gross_pay", F.round(annual / 12, 2).cast(MONEY))
        .withColumn("tax_withheld", tax)
        .select(
            F.concat("employee_id", F.lit("-"), F.date_format("m", "yyyyMM"), F.lit("-SALARY")).alias("payroll_id"),
            "employee_id",
            "department",
            F.col("m").alias("pay_period_start"),
            F.last_day("m").alias("pay_period_end"),
            "gross_pay",
            "tax_withheld",
            (F.col("gross_pay") - F.col("tax_withheld")).cast(MONEY).alias("net_pay"),
            F.date_add(F.last_day("m"), 2).alias("payment_date"),
            F.lit("Salary").alias("pay_type"),
            F.last_day("m").alias("created_at"),
        )
    )


def december_bonus(schedule: DataFrame) -> DataFrame:
    """A quarter of December's gross pay, taxed at a flat rate, paid on the last day."""
    bonus = F.round(F.col("gross_pay") * F.lit(BONUS_SHARE).cast("decimal(4,2)"), 2).cast(MONEY)
    rate = F.lit(BONUS_TAX).cast("decimal(4,2)")
    return (
        schedule.filter(F.month("pay_period_start") == 12)
        .withColumn("gross_pay", bonus)
        .select(
            F.concat(F.regexp_extract("payroll_id", "^(.*)-SALARY$", 1), F.lit("-BONUS")).alias("payroll_id"),
            "employee_id",
            "department",
            "pay_period_start",
            "pay_period_end",
            "gross_pay",
            F.round(F.col("gross_pay") * rate, 2).cast(MONEY).alias("tax_withheld"),
            F.round(F.col("gross_pay") * (1 - rate), 2).cast(MONEY).alias("net_pay"),
            F.col("pay_period_end").alias("payment_date"),
            F.lit("Bonus").alias("pay_type"),
            F.col("pay_period_end").alias("created_at"),
        )
    )
