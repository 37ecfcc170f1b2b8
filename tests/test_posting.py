from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill.operators import posting
from tests.conftest import as_list, as_set


def test_journal_anchor_values(models):
    journal = models.raw.raw_journal_entries
    row = journal.agg(
        F.count("*").alias("n"), F.sum("debit_amount").alias("d"), F.sum("credit_amount").alias("c"), F.countDistinct("transaction_ref").alias("refs")
    ).first()
    assert (row.n, row.refs, row.d, row.c) == (12260, 5485, Decimal("813159529.77"), Decimal("813159529.77"))
    assert posting.gl_unbalanced_refs(journal).count() == 0
    assert journal.select("entry_id").distinct().count() == row.n


def test_one_pass_over_bills_equals_the_two_rules(models):
    bills, accounts = models.raw.raw_vendor_bills, models.raw.raw_chart_of_accounts
    both = posting.post_vendor_bills_gl(bills, accounts).unionByName(posting.post_bill_payments_gl(bills))
    journal = models.raw.raw_journal_entries.filter("transaction_type IN ('VENDOR_BILL', 'BILL_PAYMENT')")
    assert as_list(journal.select(*both.columns)) == as_list(both)


def test_payroll_posts_three_legs(rows):
    payroll = rows(
        "payroll_id string, department string, salary_account string, gross_pay decimal(15,2), tax_withheld decimal(15,2), "
        "net_pay decimal(15,2), payment_date date, pay_type string",
        "('Y1-2000-12', 'Sales', '5300', 100, 25, 75, '2001-01-02', 'Salary')",
    )
    got = posting.post_payroll_gl(payroll)
    assert as_set(got, "entry_id", "transaction_type", "account_code", "debit_amount", "credit_amount", "description") == {
        ("Y1-2000-12-1", "PAYROLL_SALARY", "5300", Decimal("100.00"), Decimal("0.00"), "Payroll Y1-2000- — Sales (Salary)"),
        ("Y1-2000-12-2", "PAYROLL_SALARY", "1010", Decimal("0.00"), Decimal("75.00"), "Payroll Y1-2000- — Sales (Salary)"),
        ("Y1-2000-12-3", "PAYROLL_SALARY", "2100", Decimal("0.00"), Decimal("25.00"), "Payroll Y1-2000- — Sales (Salary)"),
    }
    older = posting.post_payroll_gl_by_dept(payroll)
    assert as_set(older.filter("debit_amount > 0"), "account_code") == {("6010",)}
    unknown = posting.post_payroll_gl_by_dept(payroll.withColumn("department", F.lit("Legal")))
    assert as_set(unknown.filter("debit_amount > 0"), "account_code") == {("6030",)}


def test_long_descriptions_are_cut(rows):
    bills = rows(
        "bill_id string, expense_account_id string, bill_date date, due_date date, amount decimal(15,2), status string, description string",
        f"('B1', 'A1', '2000-01-01', '2000-01-31', 10, 'Paid ', '{'x' * 200}')",
    )
    accounts = rows("account_id string, account_code string", "('A1', '6100')")
    got = posting.post_vendor_bills_gl(bills, accounts)
    assert {len(r.description) for r in got.collect()} == {len("Bill B1 — ") + 60}
    assert as_set(posting.post_bill_payments_gl(bills), "transaction_ref", "account_code") == {("B1_pmt", "2000"), ("B1_pmt", "1010")}


def test_unbalanced_refs_uses_a_tolerance(rows):
    legs = rows(
        "transaction_ref string, debit_amount decimal(15,2), credit_amount decimal(15,2)",
        "('a', 10, 0), ('a', 0, 9.99), ('b', 10, 0), ('b', 0, 9.98)",
    )
    assert as_set(posting.gl_unbalanced_refs(legs)) == {("b", Decimal("0.02"))}
