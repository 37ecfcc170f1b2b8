from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill.operators import schedules
from ledgermill.plans import annual
from tests.conftest import as_list, as_set

SUBS = "subscription_id string, customer_id string, product_id string, plan_name string, status string, mrr decimal(15,2), start_date date, end_date date, created_at date, updated_at date"


def test_billing_schedule_months(rows):
    subs = rows(
        SUBS,
        "('S1', 'C', 'P', 'Pro', 'Active', 10, '2000-11-20', NULL, NULL, NULL), "
        "('S2', 'C', 'P', 'Pro', 'Churned', 10, '1999-01-15', '2000-02-01', NULL, NULL), "
        "('S3', 'C', 'P', 'Pro', 'Churned', 10, '2001-06-01', '2001-07-01', NULL, NULL)",
    )
    got = schedules.billing_schedule(subs, "2000-01-01", "2001-01-31")
    assert as_set(got, "subscription_id", "invoice_date", "due_date", "label") == {
        ("S1", date(2000, 11, 1), date(2000, 12, 1), "November 2000"),
        ("S1", date(2000, 12, 1), date(2000, 12, 31), "December 2000"),
        ("S1", date(2001, 1, 1), date(2001, 1, 31), "January 2001"),
        ("S2", date(2000, 1, 1), date(2000, 1, 31), "January 2000"),
        ("S2", date(2000, 2, 1), date(2000, 3, 2), "February 2000"),
    }
    lines = schedules.invoice_lines_from_schedule(got)
    assert as_set(lines, "quantity", "unit_price", "line_total", "discount_pct") == {(1, Decimal("10.00"), Decimal("10.00"), Decimal("0.0000"))}


def test_active_subs_match_brute_force(rows, models):
    subs = rows(
        SUBS,
        "('a', 'C', 'P', 'x', 's', 1, '1999-06-01', NULL, NULL, NULL), ('b', 'C', 'P', 'x', 's', 1, '2000-12-31', '2001-12-31', NULL, NULL), "
        "('c', 'C', 'P', 'x', 's', 1, '2000-06-01', '2000-05-01', NULL, NULL), ('d', 'C', 'P', 'x', 's', 1, '2002-01-01', '2003-01-01', NULL, NULL), "
        "('e', 'C', 'P', 'x', 's', 1, '2000-06-01', '1999-05-01', NULL, NULL), ('f', 'C', 'P', 'x', 's', 1, NULL, NULL, NULL, NULL)",
    )

    def brute(data, years):
        return [
            (y, sum(1 for s, e in data if s and s <= date(y, 12, 31) and (e is None or e > date(y, 12, 31)))) for y in years
        ]

    for df, first, last in ((subs, 2000, 2002), (models.stg("raw_subscriptions"), 1995, 2001)):
        data = [(r.start_date, r.end_date) for r in df.collect()]
        assert as_list(annual.active_subs_at_year_end(df, first, last)) == brute(data, range(first, last + 1))


def test_payroll_schedule_raise_and_bonus(rows):
    employees = rows(
        "employee_id string, department string, salary decimal(15,2), r decimal(4,2), t decimal(4,2)", "('E1', 'Sales', 60000, 0.05, 0.25)"
    )
    pay = schedules.payroll_schedule(employees, 2000, 2001, "r", "t")
    assert pay.count() == 24
    row = pay.filter("pay_period_start = '2001-02-01'").first()
    assert (row.gross_pay, row.tax_withheld, row.net_pay) == (Decimal("5250.00"), Decimal("1312.50"), Decimal("3937.50"))
    assert (row.pay_period_end, row.payment_date) == (date(2001, 2, 28), date(2001, 3, 2))
    bonus = schedules.december_bonus(pay).filter("pay_period_start = '2001-12-01'").first()
    assert (bonus.gross_pay, bonus.tax_withheld, bonus.net_pay, bonus.payment_date) == (
        Decimal("1312.50"), Decimal("485.63"), Decimal("826.88"), date(2001, 12, 31))
    assert bonus.payroll_id == "E1-200112-BONUS"


def test_close_out(rows):
    subs = rows(SUBS, "('a', 'C', 'P', 'x', 'Active', 1, NULL, NULL, NULL, NULL), ('b', 'C', 'P', 'x', 'Active', 1, NULL, NULL, NULL, NULL)")
    churned = rows("subscription_id string, churn_date date", "('b', '2001-03-01')")
    got = schedules.close_out_subscriptions(subs, churned, "2001-08-31")
    assert got.columns == subs.columns
    assert as_set(got, "subscription_id", "status", "end_date", "updated_at") == {
        ("a", "Active", None, date(2001, 8, 31)),
        ("b", "Churned", date(2001, 3, 1), date(2001, 3, 1)),
    }


def test_annual_summary_identities(models):
    m = models
    args = [m.stg(t) for t in ("raw_invoices", "raw_payroll", "raw_vendor_bills", "raw_subscriptions", "raw_journal_entries")]
    got = annual.annual_summary(*args, 1995, 2001)
    assert got.filter("gross_profit <> total_revenue - cogs OR net <> gross_profit - payroll_opex - vendor_opex").count() == 0
    revenue = {r.year: r.total_revenue for r in got.collect()}
    assert (revenue[2001], revenue[2000]) == (Decimal("30596142.17"), Decimal("56344538.68"))
    empty = annual.annual_summary(*args, 2010, 2010).first()
    assert (empty.total_revenue, empty.gross_margin_pct) == (0, 0)


def test_churn_counts_the_exact_status_only(rows):
    df = rows("status string", "('Churned'), ('churned '), ('Active'), ('Active')")
    assert tuple(annual.churn_summary(df).first()) == (1, 4, Decimal("25.0"))


def test_pivot_has_every_type_and_fills_zero(rows):
    df = rows(
        "invoice_date date, invoice_type string, total_amount decimal(15,2)",
        "('2000-01-01', 'Subscription', 5), ('2001-01-01', 'Professional Services', 7), ('2001-01-01', 'Set.up', 9)",
    )
    got = annual.revenue_by_year_type(df)
    assert set(got.columns) == {"year", "Subscription", "Professional Services", "Set.up"}
    assert as_set(got.selectExpr("year", "cast(Subscription AS int)", "cast(`Professional Services` AS int)", "cast(`Set.up` AS int)")) == {
        (2000, 5, 0, 0),
        (2001, 0, 7, 9),
    }


def test_revenue_of_any_type_text(rows):
    from ledgermill.plans.annual import revenue_by_year_type

    df = rows(
        "invoice_date date, invoice_type string, total_amount int",
        "('2001-01-02', 'a`b.c', 1), ('2001-03-02', 'year', 2), ('2002-01-02', NULL, 3), ('2002-01-02', 'Year', 4), ('2001-01-02', 'null', 5)",
    )
    got = revenue_by_year_type(df)
    assert got.columns == ["year", "Year_2", "a`b.c", "null", "year_2_2", "null_2"] or sorted(got.columns) == sorted(set(got.columns))
    assert sorted(map(tuple, got.collect()))[0][0] == 2001
    assert revenue_by_year_type(df.limit(0)).columns == ["year"]
