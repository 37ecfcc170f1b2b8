from datetime import date, timedelta
from decimal import Decimal

import pytest

from ledgermill.operators import dims, facts
from tests.conftest import as_set

AS_OF = "2001-08-15"
INVOICE = (
    "invoice_id string, customer_id string, subscription_id string, sales_rep_id string, invoice_type string, "
    "invoice_date date, due_date date, status string, total_amount decimal(15,2), currency string, created_at date"
)
LINE = (
    "line_id string, invoice_id string, product_id string, description string, quantity decimal(10,2), "
    "unit_price decimal(15,2), discount_pct decimal(6,4), line_total decimal(15,2)"
)


def invoice(i, status, due, kind="Subscription"):
    due = "NULL" if due is None else f"'{due}'"
    return f"('{i}', 'C1', NULL, 'E1', '{kind}', '2001-01-01', {due}, {status}, 100, 'usd', '2001-01-01')"


def line(n, i, quantity, price, discount, total):
    return f"('L{n}', '{i}', 'P1', ' item ', {quantity}, {price}, {discount}, {total})"


@pytest.mark.parametrize(
    "late, bucket",
    [
        (-1, "Current (Not Due)"),
        (0, "Current (Not Due)"),
        (1, "1-30 Days Overdue"),
        (30, "1-30 Days Overdue"),
        (31, "31-60 Days Overdue"),
        (60, "31-60 Days Overdue"),
        (61, "61-90 Days Overdue"),
        (90, "61-90 Days Overdue"),
        (91, "91+ Days Overdue"),
    ],
)
def test_aging_bucket_edges(rows, late, bucket):
    due = date(2001, 8, 15) - timedelta(days=late)
    df = facts.fact_invoices(rows(INVOICE, invoice("I1", "'open '", due)), rows(LINE, line(1, "I1", 1, 1, 0, 1)), AS_OF)
    row = df.first()
    assert (row.ar_aging_bucket, row.days_past_due) == (bucket, max(late, 0))
    assert row.invoice_status == "OPEN" and row.is_paid_invoice is False


def test_missing_due_date_and_status(rows):
    invoices = rows(INVOICE, ", ".join([invoice("I1", "'Open'", None), invoice("I2", "NULL", "2001-01-02"), invoice("I3", "' paid'", None)]))
    got = facts.fact_invoices(invoices, rows(LINE, line(1, "X", 1, 1, 0, 1)), AS_OF)
    assert as_set(got, "invoice_id", "ar_aging_bucket", "days_past_due", "is_paid_invoice") == {
        ("I1", "91+ Days Overdue", 0, False),
        ("I2", "91+ Days Overdue", 0, False),
        ("I3", "Paid", 0, True),
    }


def test_invoice_lines_fan_out_and_lineless_invoice_stays(rows):
    invoices = rows(INVOICE, ", ".join([invoice("I1", "'Paid'", "2001-02-01"), invoice("I2", "'Paid'", "2001-02-01")]))
    lines = rows(LINE, ", ".join([line(1, "I1", 2, 10, 12.5, 17.5), line(2, "I1", 1, 5, 0, 5), line(3, "I9", 1, 5, 0, 5)]))
    got = facts.fact_invoices(invoices, lines, AS_OF)
    assert got.count() == 3
    assert as_set(got, "invoice_id", "gross_amount", "invoice_header_total") == {
        ("I1", Decimal("17.50"), Decimal("100.00")),
        ("I1", Decimal("5.00"), Decimal("100.00")),
        ("I2", None, Decimal("100.00")),
    }


def test_discount_rounds_to_int_but_is_used_exactly(rows):
    invoices = rows(INVOICE, invoice("I1", "'Paid'", "2001-02-01"))
    got = facts.fact_invoices(invoices, rows(LINE, line(1, "I1", 2.5, 10, 12.5, 20)), AS_OF).first()
    assert (got.quantity, got.discount_pct) == (3, 13)  # half away from zero
    assert got.line_discount_amount == Decimal("3.125")
    assert got.calculated_line_net_amount == Decimal("21.875")
    share = facts.fact_invoices(invoices, rows(LINE, line(1, "I1", 2, 10, 0.125, 20)), AS_OF, discount_scale=1).first()
    assert share.line_discount_amount == Decimal("2.5")


def test_invoices_with_and_without_lines_in_one_plan_without_a_job(spark, models):
    invoices, lines = models.stg("raw_invoices"), models.stg("raw_invoice_lines").filter("invoice_id <> 'I8'")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    got = facts.fact_invoices(invoices, lines, AS_OF)
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert got.count() == invoices.join(lines, "invoice_id", "left").count()
    assert got.filter("invoice_id = 'I8'").count() == 1 and got.filter("invoice_id = 'I8' AND product_id IS NULL").count() == 1
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and "LeftAnti" in plan


ENTRY = (
    "entry_id string, transaction_ref string, transaction_type string, account_id string, account_code string, entry_date date, "
    "debit_amount decimal(15,2), credit_amount decimal(15,2), description string, created_at date"
)
ACCOUNT = "account_id string, account_code string, account_name string, account_type string, account_subtype string, is_active boolean"


def test_journal_keeps_idle_accounts_and_drops_unknown_ones(rows):
    accounts = dims.dim_accounts(
        rows(ACCOUNT, "('A1', '1010', ' Cash ', 'Asset', 'x', true), ('A2', '4000', 'Sales', 'Revenue', 'y', true), ('A3', '3000', 'Stock', 'Equity', 'z', false)")
    )
    entries = rows(
        ENTRY,
        "('1', 'r', 'PAYMENT', 'A1', '1010', '2001-07-31', 10, 0, 'd', '2001-07-31'), "
        "('2', 'r', 'PAYMENT', 'A2', '4000', '2001-08-01', 0, 10, 'd', '2001-08-01'), "
        "('3', 'r', 'PAYMENT', 'A9', '9999', '2001-08-01', 0, 10, 'd', '2001-08-01'), "
        "('4', 'r', 'PAYMENT', NULL, NULL, '2001-08-01', 0, 10, 'd', '2001-08-01')",
    )
    got = facts.fact_journal_entries(entries, accounts, AS_OF)
    assert as_set(got, "entry_id", "account_id", "account_name", "standard_balance_amount", "is_debit", "is_closed_accounting_period", "entry_month") == {
        ("1", "A1", "CASH", Decimal("10.00"), True, True, date(2001, 7, 1)),
        ("2", "A2", "SALES", Decimal("10.00"), False, False, date(2001, 8, 1)),
        (None, None, "STOCK", None, False, False, None),
    }


def test_subscription_dates(rows):
    subs = rows(
        "subscription_id string, customer_id string, product_id string, plan_name string, status string, mrr decimal(15,2), "
        "start_date date, end_date date, created_at date, updated_at date",
        "('S1', 'C', 'P', 'x', 'Active', 10, '2001-07-01', NULL, NULL, NULL), "  # 45 days -> 1.5 -> 2 months
        "('S2', 'C', 'P', 'x', ' churned', 10, '2001-07-01', '2001-07-15', NULL, NULL), "  # 14 days -> 0
        "('S3', 'C', 'P', 'x', 'ACTIVE', 10, '2000-08-15', '2001-08-01', NULL, NULL), "  # 365 days old
        "('S4', 'C', 'P', 'x', 'Active', 10, '2000-08-14', '2001-09-30', NULL, NULL)",
    )
    got = facts.fact_subscriptions(subs, AS_OF)
    assert as_set(got, "subscription_id", "tenure_months", "account_lifecycle_stage", "days_until_renewal_or_expiration", "active_mrr_baseline") == {
        ("S1", 2, "NEW_CUSTOMER", None, Decimal("10.00")),
        ("S2", 0, "CHURNED", None, Decimal("0.00")),
        ("S3", 12, "RAMPING", -14, Decimal("10.00")),
        ("S4", 14, "MATURE_LOYAL", 46, Decimal("10.00")),
    }


def test_payroll_month_follows_payment_date(rows):
    payroll = rows(
        "payroll_id string, employee_id string, department string, pay_period_start date, pay_period_end date, gross_pay decimal(15,2), "
        "tax_withheld decimal(15,2), net_pay decimal(15,2), payment_date date, pay_type string, created_at date",
        "('Y1', 'E1', 'Sales', '2000-12-01', '2000-12-31', 100, 25, 75, '2001-01-02', 'Salary', '2000-12-31'), "
        "('Y2', 'E1', 'Sales', '2000-12-01', '2000-12-31', 0, 0, 0, '2000-12-31', 'bonus ', '2000-12-31')",
    )
    got = facts.fact_payroll(payroll)
    assert as_set(got, "payroll_id", "pay_month", "pay_year", "is_bonus", "is_salary", "effective_tax_rate") == {
        ("Y1", date(2001, 1, 1), 2001, False, True, 0.25),
        ("Y2", date(2000, 12, 1), 2000, True, False, None),
    }


def test_customer_and_employee_cleaning(rows):
    customers = dims.dim_customers(
        rows(
            "customer_id string, company_name string, industry string, segment string, region string, billing_email string, "
            "credit_limit decimal(15,2), created_at date, is_active boolean",
            "('C1', ' acme ', NULL, ' smb', ' west ', ' a@b.example', 1, NULL, true), ('C2', 'x', 'N/A', 'smb', NULL, 'nomail', 1, NULL, true)",
        )
    )
    assert as_set(customers, "customer_id", "company_name", "industry", "segment", "region", "billing_email", "email_domain") == {
        ("C1", " acme ", "UNKNOWN", " SMB", "WEST", " A@B.EXAMPLE", "B.EXAMPLE"),
        ("C2", "x", "N/A", "SMB", "UNKNOWN", "NOMAIL", ""),
    }
    employees = dims.dim_employees(
        rows(
            "employee_id string, first_name string, last_name string, department string, role string, salary decimal(15,2), "
            "hire_date date, is_active boolean, created_at date, manager_id string",
            "('E1', ' ann', 'Lee', 'g&a ', ' ceo ', 1, NULL, true, NULL, NULL), ('E2', 'bob', NULL, 'Sales', NULL, 1, NULL, true, NULL, 'E1')",
        )
    )
    assert as_set(employees, "employee_id", "first_name", "full_name", "manager_name", "manager_role") == {
        ("E1", "ANN", " ann Lee", None, None),
        ("E2", "BOB", None, " ann Lee", "CEO"),
    }
