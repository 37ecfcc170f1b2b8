"""Data-quality checks: each returns offending rows, values or counts as a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.frames import union_all
from ledgermill.operators.posting import gl_unbalanced_refs as dq_gl_balance  # noqa: F401

# The declared column rules, model by model.
NOT_NULL = {
    "stg_chart_of_accounts": ["account_id", "account_code"],
    "stg_customers": ["customer_id"],
    "stg_products": ["product_id"],
    "stg_employees": ["employee_id"],
    "stg_vendors": ["vendor_id"],
    "stg_subscriptions": ["subscription_id", "customer_id", "product_id"],
    "stg_invoices": ["invoice_id", "customer_id", "sales_rep_id"],
    "stg_invoice_lines": ["line_id", "invoice_id", "product_id"],
    "stg_payments": ["payment_id", "invoice_id", "customer_id"],
    "stg_vendor_bills": ["bill_id", "vendor_id", "expense_account_id"],
    "stg_payroll": ["payroll_id", "employee_id"],
    "stg_journal_entries": ["entry_id", "transaction_ref", "account_id"],
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id", "product_name", "created_at"],
    "dim_employees": ["employee_id", "full_name", "hire_date"],
    "dim_accounts": ["account_id", "account_code", "account_name"],
    "dim_vendors": ["vendor_id", "vendor_name", "created_at"],
    "fact_invoices": ["invoice_id", "customer_id", "invoice_date", "invoice_status"],
    "fact_payments": ["payment_id", "invoice_id", "customer_id", "payment_date"],
    "fact_journal_entries": ["entry_id", "transaction_ref", "account_id", "account_code", "entry_date"],
    "fact_subscriptions": ["subscription_id", "customer_id", "product_id", "status", "start_date"],
    "fact_payroll": ["payroll_id", "employee_id"],
    "fact_vendor_bills": [
        "bill_id",
        "vendor_id",
        "expense_account_id",
        "amount",
        "status",
        "is_overdue",
        "days_past_due",
        "silver_inserted_at",
    ],
    "rpt_pl_statement": [
        "entry_month",
        "entry_quarter",
        "entry_year",
        "account_type",
        "account_name",
        "account_type_sort_key",
        "financial_statement_line_item",
    ],
}

UNIQUE = {
    "stg_chart_of_accounts": "account_id",
    "stg_customers": "customer_id",
    "stg_products": "product_id",
    "stg_employees": "employee_id",
    "stg_vendors": "vendor_id",
    "stg_subscriptions": "subscription_id",
    "stg_invoices": "invoice_id",
    "stg_invoice_lines": "line_id",
    "stg_payments": "payment_id",
    "stg_vendor_bills": "bill_id",
    "stg_payroll": "payroll_id",
    "stg_journal_entries": "entry_id",
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "dim_employees": "employee_id",
    "dim_accounts": "account_id",
    "dim_vendors": "vendor_id",
    "fact_payments": "payment_id",
    "fact_journal_entries": "entry_id",
    "fact_subscriptions": "subscription_id",
    "fact_payroll": "payroll_id",
    "fact_vendor_bills": "bill_id",
}

ACCEPTED = {
    ("fact_payroll", "pay_type"): ["SALARY", "BONUS", "HOURLY", "COMMISSION", "SEVERANCE"],
    ("fact_vendor_bills", "status"): ["PAID", "OPEN", "PENDING", "VOID", "REJECTED"],
    ("fact_vendor_bills", "is_overdue"): [True, False],
    ("rpt_pl_statement", "account_type"): ["REVENUE", "COGS", "OPEX"],
}

# Foreign keys: child table, column, parent table, parent key.
FOREIGN_KEYS = [
    ("stg_employees", "manager_id", "stg_employees", "employee_id"),
    ("stg_vendors", "expense_account_code", "stg_chart_of_accounts", "account_code"),
    ("stg_subscriptions", "customer_id", "stg_customers", "customer_id"),
    ("stg_subscriptions", "product_id", "stg_products", "product_id"),
    ("stg_invoices", "customer_id", "stg_customers", "customer_id"),
    ("stg_invoices", "subscription_id", "stg_subscriptions", "subscription_id"),
    ("stg_invoices", "sales_rep_id", "stg_employees", "employee_id"),
    ("stg_invoice_lines", "invoice_id", "stg_invoices", "invoice_id"),
    ("stg_invoice_lines", "product_id", "stg_products", "product_id"),
    ("stg_payments", "invoice_id", "stg_invoices", "invoice_id"),
    ("stg_payments", "customer_id", "stg_customers", "customer_id"),
    ("stg_vendor_bills", "vendor_id", "stg_vendors", "vendor_id"),
    ("stg_vendor_bills", "expense_account_id", "stg_chart_of_accounts", "account_id"),
    ("stg_payroll", "employee_id", "stg_employees", "employee_id"),
    ("stg_journal_entries", "account_id", "stg_chart_of_accounts", "account_id"),
]


@dataclass
class Watch:
    """What the declared column rules of a model found while it was written."""

    model: str
    nulls: dict[str, int]
    unaccepted: dict[str, int]


def watch(df: DataFrame, model: str, rules: str | None = None) -> tuple[DataFrame, Callable[[], Watch]]:
    """``df`` with its NULLs and unaccepted values counted as it is written, and how to get the counts then.

    The counts are metrics of the very job that stores the model, so checking it costs no
    scan. ``rules`` names the model whose rules hold, if it is another one.
    """
    counts, as_watch = _rule_counts(df, model, rules or model)
    if not counts:
        return df, lambda: as_watch({})
    seen = Observation()
    return df.observe(seen, *counts), lambda: as_watch(seen.get)


def counted(df: DataFrame, model: str) -> Watch:
    """The same of a model that is not stored, by one scan of the columns that its rules name."""
    counts, as_watch = _rule_counts(df, model, model)
    return as_watch(df.agg(*counts).first().asDict() if counts else {})


def _rule_counts(df: DataFrame, model: str, rules: str) -> tuple[list[Column], Callable[[Mapping[str, int]], Watch]]:
    """The counts that the rules named ``rules`` ask for, and how these make a Watch."""
    columns = [c for c in NOT_NULL.get(rules, []) if c in df.columns]
    listed = {c: values for (m, c), values in ACCEPTED.items() if m == rules and c in df.columns}
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in columns]
    others = [F.count_if(~F.col(c).isin(values)).alias(f"other {c}") for c, values in listed.items()]

    def as_watch(n: Mapping[str, int]) -> Watch:
        return Watch(model, {c: n[f"null {c}"] for c in columns}, {c: n[f"other {c}"] for c in listed})

    return nulls + others, as_watch


def dq_not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """NULL count of every listed column, all in one pass."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.lit(model).alias("model"), F.inline(rows))


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values seen more than once, with their counts."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def dq_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """How many values of a key column repeat."""
    failures = duplicate_values(df, column).agg(F.count(F.lit(1)).alias("failures"))
    return failures.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), "failures")


def dq_accepted_values(df: DataFrame, model: str, column: str, values: list) -> DataFrame:
    """Values outside the accepted list with their counts; NULL passes."""
    return (
        df.filter(~F.col(column).isin(values))
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), "value", "failures")
    )


def dq_orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    parents = parent.select(F.col(key).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(parents, column, "left_anti")


def check_not_null(models: Mapping[str, DataFrame]) -> DataFrame:
    """All declared not-null rules of the given models, by a scan of each."""
    return union_all([dq_not_null(models[m], m, cols) for m, cols in NOT_NULL.items() if m in models])


def watched_not_null(spark: SparkSession, watches: Mapping[str, Watch]) -> DataFrame:
    """All declared not-null rules of models that were watched while they were stored; no model is read."""
    rows = [(m, c, watches[m].nulls[c]) for m, cols in NOT_NULL.items() if m in watches for c in cols]
    return spark.createDataFrame(rows, "model string, column_name string, failures long")


def check_unique(models: Mapping[str, DataFrame]) -> DataFrame:
    """All declared uniqueness rules of the given models: a scan of each key column and one exchange for all.

    The values of all models meet in one grouping, combined on the map side, so a value
    repeated in a third of a model's rows is one row a task.
    """
    rules = [(m, c) for m, c in UNIQUE.items() if m in models]
    values = [
        models[m].filter(F.col(c).isNotNull()).select(F.lit(i).alias("rule"), F.col(c).cast("string").alias("value"))
        for i, (m, c) in enumerate(rules)
    ]
    seen = union_all(values).groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n"))
    repeated = [F.count_if((F.col("rule") == i) & (F.col("n") > 1)).alias(f"n{i}") for i in range(len(rules))]
    rows = [F.struct(F.lit(m).alias("model"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("failures")) for i, (m, c) in enumerate(rules)]
    return seen.agg(*repeated).select(F.inline(F.array(*rows)))


def check_accepted_values(models: Mapping[str, DataFrame]) -> DataFrame:
    """All declared accepted-value rules of the given models."""
    return union_all([dq_accepted_values(models[m], m, c, vals) for (m, c), vals in ACCEPTED.items() if m in models])


def watched_accepted_values(models: Mapping[str, DataFrame], watches: Mapping[str, Watch]) -> DataFrame | None:
    """The same of models that were watched while they were stored: only a column that has such values is read, to list them."""
    found = [
        dq_accepted_values(models[m], m, c, values)
        for (m, c), values in ACCEPTED.items()
        if m in watches and watches[m].unaccepted[c]
    ]
    return union_all(found) if found else None


def check_orphans(models: Mapping[str, DataFrame]) -> DataFrame:
    """Orphan count of every foreign key whose two tables are given: one scan a table and one exchange for all.

    Every row gives its foreign keys and, where others refer to it, its own key, as
    (referred key, value, rule). Grouped by key and value, combined on the map side, a
    value without a parent counts for the rules that name it, however often it occurs.
    """
    rules = [r for r in FOREIGN_KEYS if r[0] in models and r[2] in models]
    parents = list(dict.fromkeys((parent, key) for _, _, parent, key in rules))

    def entry(ref: tuple[str, str], column: str, rule: int):
        return F.struct(F.lit(parents.index(ref)).alias("ref"), F.col(column).cast("string").alias("value"), F.lit(rule).alias("rule"))

    entries = []
    for table in dict.fromkeys(t for child, _, parent, _ in rules for t in (child, parent)):
        named = [entry((parent, key), c, i) for i, (child, c, parent, key) in enumerate(rules) if child == table]
        own = [entry((parent, key), key, -1) for parent, key in parents if parent == table]
        entries.append(models[table].select(F.inline(F.array(*named, *own))).filter(F.col("value").isNotNull()))
    by_rule = [F.count_if(F.col("rule") == i).alias(f"n{i}") for i in range(len(rules))]
    met = union_all(entries).groupBy("ref", "value").agg(F.max(F.col("rule") == -1).alias("known"), *by_rule)
    lost = met.agg(*[F.coalesce(F.sum(F.when(~F.col("known"), F.col(f"n{i}"))), F.lit(0)).alias(f"n{i}") for i in range(len(rules))])
    rows = [
        F.struct(F.lit(child).alias("model"), F.lit(c).alias("column_name"), F.lit(parent).alias("parent"), F.col(f"n{i}").alias("failures"))
        for i, (child, c, parent, _) in enumerate(rules)
    ]
    return lost.select(F.inline(F.array(*rows)))
