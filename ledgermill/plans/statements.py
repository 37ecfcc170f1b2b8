"""Financial statements built on one monthly aggregate of the ledger.

``ledger_months`` reads the ledger once and reduces it to a row per account and
month; everything after that works on months x accounts rows, so the spine, the
running totals and the lags never touch ledger-sized data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.columns import (
    by_month,
    change_percent,
    month_of,
    percent,
    prior,
    quarter_of,
    row_key,
    running,
    with_variance,
)
from ledgermill.operators.facts import standard_balance
from ledgermill.operators.prefix import running_total

PNL_TYPES = ["REVENUE", "COGS", "OPEX"]
BALANCE_TYPES = ["ASSET", "LIABILITY", "EQUITY"]
CASH_ACCOUNT = "1010"
AMOUNT = "decimal(24,2)"


def ledger_months(entries: DataFrame, accounts: DataFrame) -> DataFrame:
    """Normal-direction balance per account and month, straight from ledger legs.

    Sums per (account, month) are combined on the map side before anything is
    joined, so a cash or receivables account with a third of the legs costs no
    more than any other. Joining the small aggregate from the accounts keeps
    never-posted accounts with a NULL month and drops unknown accounts.
    """
    totals = entries.groupBy("account_id", month_of(F.col("entry_date").cast("date")).alias("entry_month")).agg(
        F.sum("debit_amount").alias("debit"), F.sum("credit_amount").alias("credit")
    )
    attributes = accounts.select("account_id", "account_name", "account_type", "account_subtype")
    return attributes.join(totals, "account_id", "left").select(
        "entry_month",
        "account_name",
        "account_type",
        "account_subtype",
        standard_balance(F.col("debit"), F.col("credit")).alias("amount"),
    )


def ledger_months_from_fact(fact: DataFrame) -> DataFrame:
    """The same aggregate from a stored journal fact."""
    return fact.groupBy("entry_month", "account_name", "account_type", "account_subtype").agg(
        F.sum("standard_balance_amount").alias("amount")
    )


def account_spine(accounts: DataFrame, types: list[str]) -> DataFrame:
    """Distinct accounts of the given types."""
    return accounts.filter(F.col("account_type").isin(types)).select(
        "account_name", "account_type", "account_subtype"
    ).distinct()


def _calendar(amounts: DataFrame, include_null_month: bool, fill_gaps: bool) -> Column:
    """All ledger months as one array, at most twelve a year; the NULL month comes last if there is one."""
    months = amounts.select("entry_month").distinct()
    known = F.array_sort(F.collect_set("entry_month"))
    if fill_gaps:
        known = F.when(F.count("entry_month") > 0, F.sequence(F.min("entry_month"), F.max("entry_month"), F.expr("interval 1 month"))).otherwise(known)
    if include_null_month:
        nothing = F.array(F.lit(None).cast("date"))
        known = F.when(F.count("entry_month") < F.count(F.lit(1)), F.concat(known, nothing)).otherwise(known)
    return months.agg(known).scalar()


def month_account_matrix(
    amounts: DataFrame,
    accounts: DataFrame,
    types: list[str],
    amount_types: list[str] | None = None,
    include_null_month: bool = True,
    fill_gaps: bool = False,
) -> DataFrame:
    """Every ledger month x every account of ``types`` with its amount or 0.

    This product is the report itself (months x accounts): every account carries the
    array of months and is expanded by it, and the sums join on month and account name.
    The NULL month matches nothing and stays at 0.
    """
    if amount_types is not None:
        # Keep every month, but only amounts of the wanted types.
        amounts = amounts.withColumn("amount", F.when(F.col("account_type").isin(amount_types), F.col("amount")))
    calendar = _calendar(amounts, include_null_month, fill_gaps)
    cells = account_spine(accounts, types).withColumn("months", calendar).withColumn("entry_month", F.explode("months"))
    sums = amounts.groupBy("entry_month", "account_name").agg(F.sum("amount").cast(AMOUNT).alias("amount"))
    return cells.join(sums, ["entry_month", "account_name"], "left").select(
        "entry_month",
        quarter_of("entry_month").alias("entry_quarter"),
        F.year("entry_month").alias("entry_year"),
        F.month("entry_month").alias("entry_month_num"),
        "account_type",
        "account_subtype",
        "account_name",
        F.coalesce("amount", F.lit(0).cast(AMOUNT)).alias("period_amount"),
    )


def _pick(column: str, choices: dict, default=None) -> Column:
    result = F.lit(default)
    for value, out in choices.items():
        result = F.when(F.col(column) == value, out).otherwise(result)
    return result


def rpt_pl_statement(
    amounts: DataFrame,
    accounts: DataFrame,
    budget: DataFrame | None = None,
    include_null_month: bool = True,
    fill_gaps: bool = False,
) -> DataFrame:
    """Monthly profit and loss with year-to-date, month, year and budget variances.

    ``budget`` (entry_month, account_name, budget_amount) replaces the zero budget.
    Costs are signed negative. The prior-year column looks twelve rows back.
    """
    matrix = month_account_matrix(
        amounts, accounts, PNL_TYPES, include_null_month=include_null_month, fill_gaps=fill_gaps
    )
    if budget is None:
        matrix = matrix.withColumn("budget_period_amount", F.lit(0).cast(AMOUNT))
    else:
        planned = budget.groupBy("entry_month", "account_name").agg(
            F.sum("budget_amount").cast(AMOUNT).alias("budget_period_amount")
        )
        matrix = matrix.join(planned, ["entry_month", "account_name"], "left").fillna(0, ["budget_period_amount"])

    def signed(c: str) -> Column:
        return F.when(F.col("account_type") == "REVENUE", F.col(c)).otherwise(-F.col(c))

    by_account = by_month("account_name", extra=("account_type", "account_subtype"))
    in_year = running(by_month("account_name", "entry_year", extra=("account_type", "account_subtype")))
    revenue = F.sum(F.when(F.col("account_type") == "REVENUE", F.col("period_amount")))
    subtype_key = F.when(F.col("account_type") == "OPEX", _pick("account_subtype", {"SALES_MARKETING": 1, "R&D": 2, "G&A": 3}, 9)).otherwise(9)
    # One exchange by account serves both lags and the year-to-date total.
    pnl = (
        matrix.withColumn("month_revenue", revenue.over(Window.partitionBy("entry_month")))
        .withColumn("signed_period_amount", signed("period_amount"))
        .withColumn("budget_amount", signed("budget_period_amount"))
        .withColumns(
            {
                "prior_month_amount": prior("signed_period_amount", 1, by_account),
                "prior_year_same_month_amount": prior("signed_period_amount", 12, by_account),
            }
        )
        .withColumn("ytd_cumulative_amount", F.sum("signed_period_amount").over(in_year))
    )
    amount = F.col("signed_period_amount")

    def variance(before: str, name: str) -> list[Column]:
        return [
            F.col(before),
            (amount - F.col(before)).alias(f"{name}_variance_abs"),
            change_percent(amount, F.col(before)).alias(f"{name}_variance_pct"),
        ]

    type_key = _pick("account_type", {"REVENUE": 1, "COGS": 2, "OPEX": 3}, 9)
    return pnl.select(
        "entry_month",
        "entry_quarter",
        "entry_year",
        "entry_month_num",
        "account_type",
        "account_subtype",
        "account_name",
        _pick(
            "account_type",
            {"REVENUE": "Gross Revenue", "COGS": "Cost of Goods Sold", "OPEX": "Operating Expenses"},
            "Other",
        ).alias("financial_statement_line_item"),
        type_key.alias("account_type_sort_key"),
        subtype_key.alias("account_subtype_sort_key"),
        (type_key * 100 + subtype_key).alias("display_sort_key"),
        "period_amount",
        "signed_period_amount",
        "ytd_cumulative_amount",
        *variance("prior_month_amount", "mom"),
        *variance("prior_year_same_month_amount", "yoy"),
        "budget_amount",
        (amount - F.col("budget_amount")).alias("actuals_vs_budget_abs"),
        change_percent(amount, F.col("budget_amount")).alias("actuals_vs_budget_pct"),
        percent(F.col("period_amount"), F.col("month_revenue")).alias("pct_of_revenue"),
        row_key("entry_month", "account_name").alias("surrogate_key"),
    )


def rpt_balance_sheet(
    amounts: DataFrame, accounts: DataFrame, include_null_month: bool = True, fill_gaps: bool = False
) -> DataFrame:
    """Closing balance per account and month: running total of all movements."""
    matrix = month_account_matrix(
        amounts, accounts, BALANCE_TYPES, BALANCE_TYPES, include_null_month, fill_gaps
    ).withColumnRenamed("period_amount", "period_movement")
    by_account = by_month("account_name", extra=("account_type", "account_subtype"))
    sheet = matrix.withColumn("closing_balance", F.sum("period_movement").over(running(by_account)))
    sheet = with_variance(sheet, "closing_balance", by_account, 1, "prior_month_balance", "mom_balance_change", "mom_balance_pct")
    return sheet.select(
        "entry_month",
        "entry_quarter",
        "entry_year",
        "account_type",
        "account_subtype",
        "account_name",
        _pick("account_type", {"ASSET": "Assets", "LIABILITY": "Liabilities", "EQUITY": "Equity"}).alias("bs_section"),
        _pick("account_type", {"ASSET": 1, "LIABILITY": 2, "EQUITY": 3}).cast("int").alias("section_sort_key"),
        "period_movement",
        "closing_balance",
        "prior_month_balance",
        "mom_balance_change",
        "mom_balance_pct",
        row_key("entry_month", "account_name").alias("surrogate_key"),
    )


def rpt_cash_flow(fact: DataFrame) -> DataFrame:
    """Direct-method cash flow of the cash account by month and transaction type.

    The ledger is filtered and summed first. The cumulative balance then runs
    over all rows in month order, with category and type breaking ties within a
    month: summed by ranges of that order, however many transaction types there are
    (the summed rows are written once while the plan is built).
    """
    kind = F.col("transaction_type")
    payroll = kind.isin("PAYROLL_SALARY", "PAYROLL_BONUS")
    category = (
        F.when(kind == "PAYMENT", "Cash Received from Customers")
        .when(kind == "BILL_PAYMENT", "Cash Paid to Vendors")
        .when(payroll, "Cash Paid for Payroll")
        .otherwise("Other Operating Cash")
    )
    sort_key = F.when(kind == "PAYMENT", 1).when(kind == "BILL_PAYMENT", 2).when(payroll, 3).otherwise(9)
    monthly = (
        fact.filter(F.col("account_code").cast("string") == CASH_ACCOUNT)
        .groupBy("entry_month", "entry_quarter", "entry_year", "transaction_type")
        .agg(
            F.sum("debit_amount").cast(AMOUNT).alias("total_cash_inflow"),
            F.sum("credit_amount").cast(AMOUNT).alias("total_cash_outflow"),
            F.sum(F.col("debit_amount") - F.col("credit_amount")).cast(AMOUNT).alias("net_cash_movement"),
        )
        .withColumn("cash_flow_section", F.lit("Operating Activities"))
        .withColumn("cash_flow_category", category)
        .withColumn("category_sort_key", sort_key)
    )
    in_order = [F.col(c).asc_nulls_last() for c in ("entry_month", "category_sort_key", "transaction_type")]
    flow = running_total(monthly, in_order, "net_cash_movement", "cumulative_cash_balance")
    by_category = by_month("cash_flow_category", extra=("transaction_type",))
    flow = with_variance(
        flow, "net_cash_movement", by_category, 1, "prior_month_net_cash", "mom_cash_variance", "mom_cash_variance_pct"
    )
    return flow.select(
        "entry_month",
        "entry_quarter",
        "entry_year",
        "cash_flow_section",
        "cash_flow_category",
        "category_sort_key",
        "transaction_type",
        "total_cash_inflow",
        "total_cash_outflow",
        "net_cash_movement",
        "cumulative_cash_balance",
        "prior_month_net_cash",
        "mom_cash_variance",
        "mom_cash_variance_pct",
        row_key("entry_month", "cash_flow_category").alias("surrogate_key"),
    )
