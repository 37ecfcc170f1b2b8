"""Declared raw schemas, load keys and bronze column lists."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(15,2)"

RAW_DDL = {
    "raw_chart_of_accounts": (
        "account_id string, account_code string, account_name string, "
        "account_type string, account_subtype string, is_active boolean"
    ),
    "raw_customers": (
        "customer_id string, company_name string, industry string, segment string, region string, "
        f"billing_email string, credit_limit {MONEY}, created_at date, is_active boolean"
    ),
    "raw_products": (
        f"product_id string, product_name string, product_category string, unit_price {MONEY}, "
        "description string, is_active boolean, created_at date"
    ),
    "raw_employees": (
        "employee_id string, first_name string, last_name string, department string, role string, "
        f"salary {MONEY}, hire_date date, is_active boolean, created_at date, manager_id string, "
        "cost_center string, salary_account string"
    ),
    "raw_vendors": (
        "vendor_id string, vendor_name string, vendor_category string, payment_terms_days int, "
        "expense_account_code string, is_active boolean, created_at date"
    ),
    "raw_subscriptions": (
        "subscription_id string, customer_id string, product_id string, plan_name string, status string, "
        f"mrr {MONEY}, start_date date, end_date date, created_at date, updated_at date"
    ),
    "raw_invoices": (
        "invoice_id string, customer_id string, subscription_id string, sales_rep_id string, "
        f"invoice_type string, invoice_date date, due_date date, status string, total_amount {MONEY}, "
        "currency string, created_at date"
    ),
    "raw_invoice_lines": (
        "line_id string, invoice_id string, product_id string, description string, quantity int, "
        f"unit_price {MONEY}, discount_pct decimal(6,4), line_total {MONEY}"
    ),
    "raw_payments": (
        f"payment_id string, invoice_id string, customer_id string, payment_date date, amount {MONEY}, "
        "payment_method string, currency string, created_at date"
    ),
    "raw_vendor_bills": (
        "bill_id string, vendor_id string, expense_account_id string, bill_date date, due_date date, "
        f"amount {MONEY}, status string, description string, currency string, created_at date"
    ),
    "raw_payroll": (
        "payroll_id string, employee_id string, department string, pay_period_start date, "
        f"pay_period_end date, gross_pay {MONEY}, tax_withheld {MONEY}, net_pay {MONEY}, "
        "payment_date date, pay_type string, created_at date, cost_center string, salary_account string"
    ),
    "raw_journal_entries": (
        "entry_id string, transaction_ref string, transaction_type string, account_id string, "
        f"account_code string, entry_date date, debit_amount {MONEY}, credit_amount {MONEY}, "
        "description string, created_at date"
    ),
}

# Columns that only the revised files have.
OPTIONAL = {
    "raw_employees": ("cost_center", "salary_account"),
    "raw_payroll": ("cost_center", "salary_account"),
}

# Upsert key of each load, in the order the tables are loaded.
LOAD_KEYS = {
    "raw_chart_of_accounts": ["account_id"],
    "raw_customers": ["customer_id"],
    "raw_products": ["product_id"],
    "raw_employees": ["employee_id"],
    "raw_vendors": ["vendor_id"],
    "raw_subscriptions": ["subscription_id"],
    "raw_invoices": ["invoice_id"],
    "raw_invoice_lines": ["line_id", "invoice_id"],
    "raw_payments": ["payment_id"],
    "raw_vendor_bills": ["bill_id", "vendor_id"],
    "raw_payroll": ["payroll_id"],
    "raw_journal_entries": ["entry_id", "transaction_ref"],
}

RAW_TABLES = list(LOAD_KEYS)


_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    MONEY: T.DecimalType(15, 2),
    "decimal(6,4)": T.DecimalType(6, 4),
}


def raw_schema(table: str) -> T.StructType:
    """Declared schema of one raw table; needs no running session."""
    columns = [c.split(" ") for c in RAW_DDL[table].split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


def raw_schemas() -> dict[str, T.StructType]:
    """Declared schemas of all raw tables."""
    return {table: raw_schema(table) for table in RAW_TABLES}


def bronze_name(table: str) -> str:
    """``raw_x`` is staged as ``stg_x``."""
    return "stg_" + table.removeprefix("raw_")


def bronze_columns(table: str) -> list[str] | None:
    """Columns a load keeps; None keeps whatever arrives (chart of accounts)."""
    return None if table == "raw_chart_of_accounts" else raw_schema(table).names
