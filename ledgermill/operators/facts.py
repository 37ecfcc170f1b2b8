"""Fact tables: cleaned events with derived flags, ages and date keys.

Every rule that depends on "today" takes an explicit ``as_of`` date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.columns import clean_upper, month_of, quarter_of, rounded_int, status_is


def _date(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def _age(due: str, as_of: str) -> Column:
    """Days from the due date to ``as_of``."""
    return F.datediff(_date(as_of), F.col(due).cast("date"))


def _date_keys(day: Column, prefix: str) -> list[Column]:
    return [
        month_of(day).alias(f"{prefix}_month"),
        quarter_of(day).alias(f"{prefix}_quarter"),
        F.year(day).alias(f"{prefix}_year"),
    ]


def _unpaid_and_late(status: str, due: str, as_of: str) -> Column:
    return (clean_upper(status) != "PAID") & (_age(due, as_of) > 0)


def aging_bucket(status: str, due: str, as_of: str) -> Column:
    """Receivables age band; a missing due date falls into the oldest band."""
    age = _age(due, as_of)
    return (
        F.when(status_is(status, "PAID"), "Paid")
        .when(age <= 0, "Current (Not Due)")
        .when(age <= 30, "1-30 Days Overdue")
        .when(age <= 60, "31-60 Days Overdue")
        .when(age <= 90, "61-90 Days Overdue")
        .otherwise("91+ Days Overdue")
    )


def fact_invoices(invoices: DataFrame, lines: DataFrame, as_of: str, discount_scale: int = 100) -> DataFrame:
    """One row per invoice line; an invoice without lines keeps one row.

    ``discount_scale`` is what a full discount looks like in ``discount_pct``
    (100 when it holds percentages). ``invoice_header_total`` repeats per line.

    The left join is put together from an inner join, which adaptive execution can
    split on either side when one invoice holds a large share of the lines, and the
    invoices that an anti join against the distinct line keys leaves. The keys are
    combined on the map side, so a hot invoice is one row there.
    """
    day, due = F.col("invoice_date").cast("date"), F.col("due_date").cast("date")
    headers = invoices.select(
        "invoice_id",
        "customer_id",
        "subscription_id",
        "sales_rep_id",
        F.upper("invoice_type").alias("invoice_type"),
        day.alias("invoice_date"),
        due.alias("due_date"),
        clean_upper("status").alias("invoice_status"),
        "currency",
        F.col("created_at").cast("date").alias("invoice_created_at"),
        F.col("total_amount").alias("invoice_header_total"),
        status_is("status", "PAID").alias("is_paid_invoice"),
        F.datediff(due, day).alias("payment_term_days_window"),
        F.when(_unpaid_and_late("status", "due_date", as_of), _age("due_date", as_of)).otherwise(0).alias("days_past_due"),
        aging_bucket("status", "due_date", as_of).alias("ar_aging_bucket"),
        *_date_keys(day, "invoice"),
    )
    amount = F.col("quantity") * F.col("unit_price")
    share = F.col("discount_pct") * F.lit(1 / discount_scale).cast("decimal(5,4)")
    details = lines.select(
        "invoice_id",
        "product_id",
        clean_upper("description").alias("product_description"),
        rounded_int("quantity").alias("quantity"),
        "unit_price",
        rounded_int("discount_pct").alias("discount_pct"),
        F.col("line_total").alias("gross_amount"),
        (amount * share).cast("decimal(28,8)").alias("line_discount_amount"),
        amount.alias("_amount"),
    )
    details = details.withColumn(
        "calculated_line_net_amount", (F.col("_amount") - F.col("line_discount_amount")).cast("decimal(28,8)")
    ).drop("_amount")
    booked = headers.join(details, "invoice_id")
    bare = headers.join(lines.select("invoice_id").distinct(), "invoice_id", "left_anti")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in details.schema.fields if f.name != "invoice_id"]
    return booked.unionByName(bare.select("*", *missing))


def _posted(entries: DataFrame) -> DataFrame:
    day = F.col("entry_date").cast("date")
    return entries.select(
        "entry_id",
        "transaction_ref",
        "transaction_type",
        "account_id",
        "account_code",
        day.alias("entry_date"),
        "debit_amount",
        "credit_amount",
        "description",
        F.col("created_at").cast("date").alias("created_at"),
    )


def standard_balance(debit: Column, credit: Column, account_type: str = "account_type") -> Column:
    """Amount in the account's normal direction."""
    credit_side = clean_upper(account_type).isin("LIABILITY", "EQUITY", "REVENUE")
    return F.when(credit_side, credit - debit).otherwise(debit - credit)


def fact_journal_entries(entries: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """Ledger legs with account attributes; a never-posted account keeps one empty row.

    The reference semantics are an outer join preserving the accounts. Shuffling
    the ledger on a few dozen account ids would put a third of it in one task,
    so the legs meet the accounts in an inner join (planned as a broadcast while
    the chart of accounts is small) and the never-posted accounts are added from
    an anti join against the distinct posted ids.
    """
    attributes = accounts.select(
        "account_id",
        "account_name",
        "account_type",
        "account_subtype",
        F.col("is_active").alias("account_is_active"),
    )
    legs = _posted(entries)
    booked = legs.join(attributes, "account_id")
    idle = attributes.join(legs.select("account_id").distinct(), "account_id", "left_anti").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in legs.schema.fields],
        *[c for c in attributes.columns if c != "account_id"],
    )
    rows = booked.unionByName(idle)
    debit, credit, day = F.col("debit_amount"), F.col("credit_amount"), F.col("entry_date")
    first_open_day = F.trunc(_date(as_of), "month")
    return rows.select(
        *legs.columns,
        "account_name",
        "account_type",
        "account_subtype",
        "account_is_active",
        (debit - credit).alias("net_amount"),
        F.coalesce(debit > 0, F.lit(False)).alias("is_debit"),
        *_date_keys(day, "entry"),
        standard_balance(debit, credit).alias("standard_balance_amount"),
        F.coalesce(day < first_open_day, F.lit(False)).alias("is_closed_accounting_period"),
    )


def fact_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "payment_id",
        "invoice_id",
        "customer_id",
        F.col("payment_date").cast("date").alias("payment_date"),
        "amount",
        clean_upper("payment_method").alias("payment_method"),
        "currency",
        F.col("created_at").cast("date").alias("created_at"),
    )


def fact_payroll(payroll: DataFrame) -> DataFrame:
    """Payroll rows; date keys follow the payment date, not the pay period."""
    paid_on = F.col("payment_date").cast("date")
    gross = F.col("gross_pay").cast("double")
    return payroll.select(
        "payroll_id",
        "employee_id",
        "department",
        F.col("pay_period_start").cast("date").alias("pay_period_start"),
        F.col("pay_period_end").cast("date").alias("pay_period_end"),
        paid_on.alias("payment_date"),
        "gross_pay",
        "tax_withheld",
        "net_pay",
        clean_upper("pay_type").alias("pay_type"),
        F.col("created_at").cast("date").alias("created_at"),
        status_is("pay_type", "BONUS").alias("is_bonus"),
        status_is("pay_type", "SALARY").alias("is_salary"),
        (F.col("tax_withheld").cast("double") / F.nullif(gross, F.lit(0.0))).alias("effective_tax_rate"),
        *_date_keys(paid_on, "pay"),
    )


def fact_subscriptions(subscriptions: DataFrame, as_of: str) -> DataFrame:
    start, end, today = F.col("start_date").cast("date"), F.col("end_date").cast("date"), _date(as_of)
    until = F.coalesce(end, today)
    active = status_is("status", "ACTIVE")
    age = F.datediff(today, start)
    days = F.datediff(until, start)
    # Thirtieths rounded half away from zero, in exact decimal arithmetic.
    tenure = F.round(days.cast("decimal(10,0)") / 30).cast("int")
    return subscriptions.select(
        "subscription_id",
        "customer_id",
        "product_id",
        "plan_name",
        clean_upper("status").alias("status"),
        "mrr",
        (F.col("mrr") * 12).alias("arr"),
        start.alias("start_date"),
        end.alias("end_date"),
        F.col("created_at").cast("date").alias("created_at"),
        F.col("updated_at").cast("date").alias("updated_at"),
        active.alias("is_active"),
        status_is("status", "CHURNED").alias("is_churned"),
        tenure.alias("tenure_months"),
        month_of(start).alias("start_month"),
        month_of(until).alias("end_month"),
        F.year(start).alias("start_year"),
        (F.col("mrr") * tenure).alias("lifetime_revenue_to_date"),
        F.when(active & end.isNotNull(), F.datediff(end, today)).alias("days_until_renewal_or_expiration"),
        F.when(status_is("status", "CHURNED"), "CHURNED")
        .when(age <= 90, "NEW_CUSTOMER")
        .when(age <= 365, "RAMPING")
        .otherwise("MATURE_LOYAL")
        .alias("account_lifecycle_stage"),
        F.when(active, F.col("mrr")).otherwise(F.lit(0).cast("decimal(15,2)")).alias("active_mrr_baseline"),
    )


def fact_vendor_bills(bills: DataFrame, as_of: str) -> DataFrame:
    late = _unpaid_and_late("status", "due_date", as_of)
    billed_on = F.col("bill_date").cast("date")
    return bills.select(
        "bill_id",
        "vendor_id",
        "expense_account_id",
        billed_on.alias("bill_date"),
        F.col("due_date").cast("date").alias("due_date"),
        "amount",
        clean_upper("status").alias("status"),
        "description",
        clean_upper("currency").alias("currency"),
        F.col("created_at").cast("date").alias("created_at"),
        status_is("status", "PAID").alias("is_paid"),
        F.coalesce(late, F.lit(False)).alias("is_overdue"),
        F.when(late, _age("due_date", as_of)).otherwise(0).alias("days_past_due"),
        *_date_keys(billed_on, "bill"),
    )
