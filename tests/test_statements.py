from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import dims, facts
from ledgermill.plans import serving, statements
from ledgermill.sources.fixtures import RawTables
from tests.conftest import SMALL, as_list, as_set

ACCOUNT = "account_id string, account_code string, account_name string, account_type string, account_subtype string, is_active boolean"
ENTRY = (
    "entry_id string, transaction_ref string, transaction_type string, account_id string, account_code string, entry_date date, "
    "debit_amount decimal(15,2), credit_amount decimal(15,2), description string, created_at date"
)


@pytest.fixture
def accounts(rows):
    return dims.dim_accounts(
        rows(
            ACCOUNT,
            "('A1010', '1010', 'Cash and Cash Equivalents', 'Asset', 'Current', true), ('A4000', '4000', 'Sales', 'Revenue', 'Op', true), "
            "('A5000', '5000', 'Hosting', 'COGS', 'Cost', true), ('A6100', '6100', 'Ads', 'OpEx', 'R&D', true), "
            "('A3000', '3000', 'Stock', 'Equity', 'Equity', true)",
        )
    )


def leg(n, account, day, debit=0, credit=0, kind="PAYMENT"):
    day = "NULL" if day is None else f"'{day}'"
    return f"('{n}', 'r{n}', '{kind}', 'A{account}', '{account}', {day}, {debit}, {credit}, 'd', {day})"


@pytest.fixture
def sales(rows):
    # A sale and a cost in January of two years, a sale in March; no other months.
    return rows(
        ENTRY,
        ", ".join(
            [
                leg(1, 1010, "2000-01-05", debit=100),
                leg(2, 4000, "2000-01-05", credit=100),
                leg(3, 5000, "2000-01-31", debit=30),
                leg(4, 4000, "2000-03-10", credit=50),
                leg(5, 1010, "2000-03-10", debit=50),
                leg(6, 5000, "2001-01-15", debit=20),
                leg(7, 1010, "2001-01-15", credit=20, kind="BILL_PAYMENT"),
            ]
        ),
    )


def test_both_ledger_aggregates_agree(models):
    fact = models.fact_journal_entries
    cols = ["entry_month", "account_name", "account_type", "account_subtype", "amount"]
    direct = models.ledger_months.select(*cols)
    stored = statements.ledger_months_from_fact(fact).select(*cols)
    assert as_list(direct) == as_list(stored)


def test_pl_signs_ytd_lags_and_null_month(sales, accounts):
    pnl = statements.rpt_pl_statement(statements.ledger_months(sales, accounts), accounts)
    assert pnl.count() == 4 * 3  # three months and the NULL month of the idle accounts x three accounts
    got = {(r.entry_month, r.account_name): r for r in pnl.collect()}
    jan, mar, jan1 = date(2000, 1, 1), date(2000, 3, 1), date(2001, 1, 1)
    assert got[jan, "HOSTING"].signed_period_amount == Decimal("-30")
    assert got[mar, "SALES"].ytd_cumulative_amount == Decimal("150")
    assert got[jan1, "SALES"].ytd_cumulative_amount == 0  # resets in January
    # The prior month is the prior ledger month, the prior year is twelve rows back.
    assert got[mar, "SALES"].prior_month_amount == Decimal("100")
    assert got[mar, "SALES"].mom_variance_pct == Decimal("-50.00")
    assert got[jan1, "HOSTING"].prior_year_same_month_amount == 0
    assert got[jan1, "HOSTING"].yoy_variance_pct is None
    assert got[jan, "HOSTING"].pct_of_revenue == Decimal("30.00")
    assert got[jan1, "HOSTING"].pct_of_revenue is None  # no revenue that month
    idle = got[None, "SALES"]
    assert (idle.period_amount, idle.entry_year, idle.surrogate_key) == (0, None, None)
    assert idle.prior_month_amount == got[jan1, "SALES"].signed_period_amount  # NULL month is last
    assert got[jan, "ADS"].display_sort_key == 302 and got[jan, "SALES"].display_sort_key == 109


def test_pl_options(sales, accounts, rows):
    ledger = statements.ledger_months(sales, accounts)
    trimmed = statements.rpt_pl_statement(ledger, accounts, include_null_month=False)
    assert trimmed.filter("entry_month IS NULL").count() == 0 and trimmed.count() == 9
    filled = statements.rpt_pl_statement(ledger, accounts, include_null_month=False, fill_gaps=True)
    assert filled.select("entry_month").distinct().count() == 13
    row = filled.filter("account_name = 'HOSTING' AND entry_month = '2001-01-01'").first()
    assert row.prior_year_same_month_amount == Decimal("-30")
    budget = rows("entry_month date, account_name string, budget_amount decimal(15,2)", "('2000-01-01', 'SALES', 80), ('2000-01-01', 'HOSTING', 40)")
    planned = statements.rpt_pl_statement(ledger, accounts, budget=budget)
    row = planned.filter("account_name = 'HOSTING' AND entry_month = '2000-01-01'").first()
    assert (row.budget_amount, row.actuals_vs_budget_abs, row.actuals_vs_budget_pct) == (-40, 10, Decimal("25.00"))


def test_accounts_sharing_a_name_share_its_amount(sales, accounts, rows):
    twin = dims.dim_accounts(rows(ACCOUNT, "('A9', '4900', 'Sales', 'OpEx', 'Other', true)"))
    both = accounts.unionByName(twin)
    pnl = statements.rpt_pl_statement(statements.ledger_months(sales, both), both)
    assert as_set(pnl.filter("entry_month = '2000-01-01' AND account_name = 'SALES'"), "account_type", "period_amount") == {
        ("REVENUE", Decimal("100.00")),
        ("OPEX", Decimal("100.00")),
    }


def test_balance_sheet_running_total(sales, accounts):
    sheet = statements.rpt_balance_sheet(statements.ledger_months(sales, accounts), accounts)
    cash = sheet.filter("account_name = 'CASH AND CASH EQUIVALENTS'").orderBy(F.asc_nulls_last("entry_month")).collect()
    assert [r.closing_balance for r in cash] == [100, 150, 130, 130]
    assert [r.prior_month_balance for r in cash] == [0, 100, 150, 130]
    assert [r.mom_balance_pct for r in cash] == [None, Decimal("50.00"), Decimal("-13.33"), Decimal("0.00")]
    assert sheet.filter("account_name = 'STOCK' AND closing_balance = 0").count() == 4
    assert serving.kpis_cash_balance(sheet).first().cash_balance == 130
    assert serving.kpis_cash_balance(sheet.filter("account_name = 'STOCK'")).first().cash_balance == 0


def test_balance_sheet_chain_on_test_data(models):
    sheet = models.rpt_balance_sheet
    broken = sheet.filter("closing_balance <> prior_month_balance + period_movement")
    assert broken.count() == 0
    assert sheet.count() == 1020 and sheet.filter("entry_month IS NULL").count() == 12


def test_margin_of_a_year_without_revenue_is_null(sales, accounts):
    pnl = statements.rpt_pl_statement(statements.ledger_months(sales, accounts), accounts)
    row = serving.kpis_gross_margin(pnl).first()
    assert (row.entry_year, row.total_revenue, row.total_cogs, row.gross_margin_pct) == (2001, 0, 20, None)


def test_cash_flow_order_and_interleaving(rows, accounts):
    entries = rows(
        ENTRY,
        ", ".join(
            [
                leg(1, 1010, "2000-12-31", credit=5, kind="PAYROLL_BONUS"),
                leg(2, 1010, "2000-12-02", credit=40, kind="PAYROLL_SALARY"),
                leg(3, 1010, "2000-12-01", debit=100),
                leg(4, 1010, "2001-01-02", credit=40, kind="PAYROLL_SALARY"),
                leg(5, 1010, "2001-01-03", debit=7, kind="REFUND"),
                leg(6, 4000, "2001-01-03", credit=7),
            ]
        ),
    )
    flow = statements.rpt_cash_flow(facts.fact_journal_entries(entries, accounts, "2001-08-15"))
    got = [
        tuple(r)
        for r in flow.orderBy("entry_month", "category_sort_key", "transaction_type")
        .select("transaction_type", "category_sort_key", "net_cash_movement", "cumulative_cash_balance", "prior_month_net_cash")
        .collect()
    ]
    assert got == [
        ("PAYMENT", 1, 100, 100, 0),
        ("PAYROLL_BONUS", 3, -5, 95, 0),
        ("PAYROLL_SALARY", 3, -40, 55, -5),  # bonus and salary share a category
        ("PAYROLL_SALARY", 3, -40, 15, -40),
        ("REFUND", 9, 7, 22, 0),
    ]
    assert flow.select("surrogate_key").distinct().count() == 4


def test_cash_flow_total_is_the_cash_balance(models):
    total = models.rpt_cash_flow.agg(F.sum("net_cash_movement")).first()[0]
    assert total == serving.kpis_cash_balance(models.rpt_balance_sheet).first().cash_balance == Decimal("206509926.24")


def test_stored_models_are_read_and_not_derived_again(models):
    for name in ("rpt_pl_statement", "rpt_opex_by_vendor", "rpt_payroll_burn", "fact_journal_entries"):
        plan = getattr(models, name)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "l_orderkey" not in plan


def test_posting_reads_every_table_once(spark):
    raw = RawTables(spark, SMALL)
    plan = raw.raw_journal_entries._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if "Relation [l_orderkey" in x]) == 1


def test_matrix_is_neither_a_cross_nor_a_nested_loop_join(spark, models):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (statements.rpt_pl_statement, statements.rpt_balance_sheet):
            plan = report(models.ledger_months, models.dim_accounts)._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
