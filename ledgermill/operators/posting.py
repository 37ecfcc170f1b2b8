"""Double-entry posting: business events become balanced journal legs.

Each rule is a narrow projection: an event row carries an array of legs that
``inline`` expands, so posting never shuffles. Legs carry the account code;
``with_account_ids`` resolves it once for the whole journal.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.frames import union_all

CASH, RECEIVABLES, PAYABLES, ACCRUED = "1010", "1100", "2000", "2100"
SUBSCRIPTION_REVENUE, SERVICES_REVENUE = "4000", "4100"

# Salary account of each department under the older payroll rule.
DEPARTMENT_SALARY_ACCOUNT = {
    "Engineering": "6000",
    "Sales": "6010",
    "Customer Success": "6020",
    "G&A": "6030",
}
DEFAULT_SALARY_ACCOUNT = "6030"
DESCRIPTION_LENGTH = 120

_ZERO = "0"
LEG_COLUMNS = ["account_code", "debit_amount", "credit_amount"]

JOURNAL_COLUMNS = [
    "entry_id",
    "transaction_ref",
    "transaction_type",
    "account_id",
    "account_code",
    "entry_date",
    "debit_amount",
    "credit_amount",
    "description",
    "created_at",
]


def debit(account: str, amount: str) -> tuple[str, str, str]:
    """A debit leg; ``account`` and ``amount`` are SQL expressions."""
    return account, f"round({amount}, 2)", _ZERO


def credit(account: str, amount: str) -> tuple[str, str, str]:
    """A credit leg; ``account`` and ``amount`` are SQL expressions."""
    return account, _ZERO, f"round({amount}, 2)"


@dataclass(frozen=True)
class Transaction:
    """One balanced transaction an event gives rise to; all parts are SQL expressions."""

    ref: str
    kind: str
    day: str
    description: str
    legs: tuple[tuple[str, str, str], ...]
    when: str = "true"


def post(events: DataFrame, *transactions: Transaction) -> DataFrame:
    """Expand each event into the legs of its transactions, in one pass over the events.

    The expanded array holds only account, amounts and two small numbers; texts
    are picked afterwards, so a query that needs no description never builds one.
    """

    def leg(t: int, n: int, account: str, debit_amount: str, credit_amount: str) -> str:
        return (
            f"named_struct('t', {t}, 'leg', {n}, 'account_code', {account}, "
            f"'debit_amount', cast({debit_amount} AS decimal(15,2)), 'credit_amount', cast({credit_amount} AS decimal(15,2)))"
        )

    arrays = []
    for t, transaction in enumerate(transactions):
        legs = ", ".join(leg(t, n, *parts) for n, parts in enumerate(transaction.legs, 1))
        arrays.append(f"if({transaction.when}, array({legs}), array())" if transaction.when != "true" else f"array({legs})")

    def of(part: str) -> str:
        values = [getattr(transaction, part) for transaction in transactions]
        if len(values) == 1:
            return values[0]
        return "CASE t " + " ".join(f"WHEN {t} THEN {v}" for t, v in enumerate(values)) + " END"

    expanded = arrays[0] if len(arrays) == 1 else f"concat({', '.join(arrays)})"
    return events.selectExpr(
        *[f"`{c}`" for c in events.columns if c not in ("t", "leg", *LEG_COLUMNS)], f"inline({expanded})"
    ).selectExpr(
        f"{of('ref')} || '-' || leg AS entry_id",
        f"{of('ref')} AS transaction_ref",
        f"{of('kind')} AS transaction_type",
        "account_code",
        f"{of('day')} AS entry_date",
        "debit_amount",
        "credit_amount",
        f"substr({of('description')}, 1, {DESCRIPTION_LENGTH}) AS description",
        f"{of('day')} AS created_at",
    )


REVENUE_ACCOUNT = f"if(invoice_type = 'Subscription', '{SUBSCRIPTION_REVENUE}', '{SERVICES_REVENUE}')"

INVOICE = Transaction(
    ref="invoice_id",
    kind="'INVOICE'",
    day="invoice_date",
    description="concat('Invoice ', substr(invoice_id, 1, 8), ' — ', invoice_type)",
    legs=(debit(f"'{RECEIVABLES}'", "total_amount"), credit(REVENUE_ACCOUNT, "total_amount")),
)
PAYMENT = Transaction(
    ref="payment_id",
    kind="'PAYMENT'",
    day="payment_date",
    description="concat('Payment ', substr(payment_id, 1, 8), ' — ', payment_method)",
    legs=(debit(f"'{CASH}'", "amount"), credit(f"'{RECEIVABLES}'", "amount")),
)
VENDOR_BILL = Transaction(
    ref="bill_id",
    kind="'VENDOR_BILL'",
    day="bill_date",
    description="concat('Bill ', substr(bill_id, 1, 8), ' — ', substr(description, 1, 60))",
    legs=(debit("expense_code", "amount"), credit(f"'{PAYABLES}'", "amount")),
)
BILL_PAYMENT = Transaction(
    ref="bill_id || '_pmt'",
    kind="'BILL_PAYMENT'",
    day="due_date",
    description="concat('Bill payment ', substr(bill_id, 1, 8))",
    legs=(debit(f"'{PAYABLES}'", "amount"), credit(f"'{CASH}'", "amount")),
    when="lower(trim(status)) = 'paid'",
)
PAYROLL = Transaction(
    ref="payroll_id",
    kind="'PAYROLL_' || upper(pay_type)",
    day="payment_date",
    description="concat('Payroll ', substr(payroll_id, 1, 8), ' — ', department, ' (', pay_type, ')')",
    legs=(
        debit("salary_account", "gross_pay"),
        credit(f"'{CASH}'", "net_pay"),
        credit(f"'{ACCRUED}'", "tax_withheld"),
    ),
)


def post_invoices_gl(invoices: DataFrame) -> DataFrame:
    """Invoice: receivables against subscription or services revenue."""
    return post(invoices, INVOICE)


def post_payments_gl(payments: DataFrame) -> DataFrame:
    """Customer payment: cash against receivables."""
    return post(payments, PAYMENT)


def account_code_lookup(df: DataFrame, accounts: DataFrame, id_column: str, code_as: str) -> DataFrame:
    """Add the account code belonging to an account id."""
    codes = accounts.select(F.col("account_id").alias(id_column), F.col("account_code").alias(code_as))
    return df.join(codes, id_column, "left")


def with_account_ids(legs: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add the account id belonging to each leg's account code."""
    return legs.join(accounts.select("account_code", "account_id"), "account_code", "left")


def _with_expense_code(bills: DataFrame, accounts: DataFrame) -> DataFrame:
    return account_code_lookup(bills, accounts, "expense_account_id", "expense_code")


def post_vendor_bills_gl(bills: DataFrame, accounts: DataFrame) -> DataFrame:
    """Vendor bill: the bill's expense account against payables."""
    return post(_with_expense_code(bills, accounts), VENDOR_BILL)


def is_paid(status: str | Column) -> Column:
    """Paid after trimming, in any case."""
    return F.lower(F.trim(status)) == "paid"


def select_paid_for_payment(df: DataFrame) -> DataFrame:
    """Invoices or bills whose status says paid."""
    return df.filter(is_paid("status"))


def post_bill_payments_gl(bills: DataFrame) -> DataFrame:
    """Paid bill: payables against cash on the due date."""
    return post(select_paid_for_payment(bills), BILL_PAYMENT)


def post_payroll_gl(payroll: DataFrame) -> DataFrame:
    """Payroll: gross pay on the row's salary account against cash (net) and accrued tax."""
    return post(payroll, PAYROLL)


def department_account() -> Column:
    """Salary account that follows from the department."""
    pairs = [F.lit(x) for pair in DEPARTMENT_SALARY_ACCOUNT.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[F.col("department")], F.lit(DEFAULT_SALARY_ACCOUNT))


def with_salary_account(payroll: DataFrame) -> DataFrame:
    """Payroll with the account on the row, or the department's for files that have none."""
    return payroll.withColumn("salary_account", F.coalesce("salary_account", department_account()))


def post_payroll_gl_by_dept(payroll: DataFrame) -> DataFrame:
    """Older payroll rule: the salary account follows from the department."""
    return post_payroll_gl(payroll.withColumn("salary_account", department_account()))


def build_journal(
    invoices: DataFrame, payments: DataFrame, bills: DataFrame, payroll: DataFrame, accounts: DataFrame
) -> DataFrame:
    """The whole general ledger with account ids: all five posting rules, each input read once."""
    legs = [
        post(invoices, INVOICE),
        post(payments, PAYMENT),
        post(_with_expense_code(bills, accounts), VENDOR_BILL, BILL_PAYMENT),
        post(payroll, PAYROLL),
    ]
    return with_account_ids(union_all(legs), accounts).select(*JOURNAL_COLUMNS)


def gl_unbalanced_refs(journal: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Transactions whose debits and credits differ by more than ``tolerance``."""
    net = F.sum("debit_amount") - F.sum("credit_amount")
    return (
        journal.groupBy("transaction_ref")
        .agg(net.alias("imbalance"))
        .filter(F.abs("imbalance") > F.lit(tolerance).cast("decimal(15,2)"))
    )
