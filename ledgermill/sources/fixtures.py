"""Raw finance tables derived from the parquet test tables (FIXTURES.md).

``RawTables(spark, sf_dir).raw_invoices`` and so on. Everything is a lazy
DataFrame over the parquet files, so only the columns a query needs are read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators import posting

AS_OF = "2001-08-15"

# The chart of accounts (code, name, type, subtype).
CHART_OF_ACCOUNTS = [
    ("1010", "Cash and Cash Equivalents", "Asset", "Current Asset"),
    ("1100", "Accounts Receivable", "Asset", "Current Asset"),
    ("1200", "Prepaid Expenses", "Asset", "Current Asset"),
    ("1500", "Equipment", "Asset", "Non-Current Asset"),
    ("1510", "Accumulated Depreciation", "Asset", "Non-Current Asset"),
    ("2000", "Accounts Payable", "Liability", "Current Liability"),
    ("2100", "Accrued Expenses", "Liability", "Current Liability"),
    ("2200", "Deferred Revenue", "Liability", "Current Liability"),
    ("2300", "Loan Payable", "Liability", "Non-Current Liability"),
    ("3000", "Common Stock", "Equity", "Equity"),
    ("3100", "Additional Paid-in Capital", "Equity", "Equity"),
    ("3200", "Retained Earnings", "Equity", "Equity"),
    ("4000", "Subscription Revenue", "Revenue", "Operating Revenue"),
    ("4100", "Professional Services Revenue", "Revenue", "Operating Revenue"),
    ("4200", "Setup Fees", "Revenue", "Operating Revenue"),
    ("5000", "Hosting and Infrastructure", "COGS", "Cost of Revenue"),
    ("5100", "Third-party Software Costs", "COGS", "Cost of Revenue"),
    ("5200", "Professional Services Delivery", "COGS", "Cost of Revenue"),
    ("5300", "Engineering - Product Delivery", "COGS", "Cost of Revenue"),
    ("6000", "Salaries - Engineering", "OpEx", "Personnel"),
    ("6010", "Salaries - Sales", "OpEx", "Personnel"),
    ("6020", "Salaries - Customer Success", "OpEx", "Personnel"),
    ("6030", "Salaries - G&A", "OpEx", "Personnel"),
    ("6100", "Sales and Marketing", "OpEx", "Sales & Marketing"),
    ("6200", "Office and Facilities", "OpEx", "Overhead"),
    ("6300", "Professional Fees", "OpEx", "Overhead"),
    ("6400", "Software and Tools", "OpEx", "Overhead"),
    ("6500", "Depreciation Expense", "OpEx", "Overhead"),
]


# Declared schemas of the parquet tables read here, so that opening one starts no job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _text(col: str) -> str:
    return f"cast({col} as string)"


class RawTables:
    """Lazy raw tables over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def raw_chart_of_accounts(self) -> DataFrame:
        # An inline relation, so the planner knows its exact (28-row) size.
        rows = ", ".join(f"('{c}', '{n}', '{t}', '{s}')" for c, n, t, s in CHART_OF_ACCOUNTS)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(code, name, typ, sub)").selectExpr(
            "'A' || code AS account_id",
            "code AS account_code",
            "name AS account_name",
            "typ AS account_type",
            "sub AS account_subtype",
            "true AS is_active",
        )

    @cached_property
    def raw_customers(self) -> DataFrame:
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        key = _text("c_custkey")
        return (
            self.table("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                f"'C' || {key} AS customer_id",
                "CASE WHEN c_custkey % 33 = 0 THEN '  ' || c_name WHEN c_custkey % 34 = 0 THEN upper(c_name) "
                "ELSE c_name END AS company_name",
                "CASE WHEN c_custkey % 25 = 0 THEN NULL WHEN c_custkey % 26 = 0 THEN 'N/A' "
                "ELSE c_mktsegment END AS industry",
                "CASE WHEN c_acctbal < 2500 THEN 'SMB' WHEN c_acctbal < 7500 THEN 'Mid-Market' "
                "ELSE 'Enterprise' END AS segment",
                "CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE r_name END AS region",
                f"CASE WHEN c_custkey % 40 = 0 THEN ' ' ELSE '' END || 'billing' || {key} || '@' || "
                "lower(n_name) || '.example' AS billing_email",
                "cast(10000 * (1 + c_custkey % 10) AS decimal(15,2)) AS credit_limit",
                "date_add(date'1995-01-01', cast(c_custkey % 365 AS int)) AS created_at",
                "true AS is_active",
            )
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        return self.table("part").selectExpr(
            f"'P' || {_text('p_partkey')} AS product_id",
            "p_name AS product_name",
            "CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'Professional Services' "
            "ELSE 'Subscription' END AS product_category",
            "cast(p_retailprice AS decimal(15,2)) AS unit_price",
            "p_brand || ' ' || p_type AS description",
            "true AS is_active",
            "date'1994-12-01' AS created_at",
        )

    @cached_property
    def raw_employees(self) -> DataFrame:
        uid = _text("user_id")
        return (
            self.table("events")
            .select("user_id")
            .distinct()
            .selectExpr(
                f"'E' || {uid} AS employee_id",
                f"CASE WHEN user_id % 10 = 3 THEN ' First' ELSE 'First' END || {uid} AS first_name",
                f"'Last' || {uid} AS last_name",
                "CASE user_id % 4 WHEN 0 THEN 'Engineering' WHEN 1 THEN 'Sales' "
                "WHEN 2 THEN 'Customer Success' ELSE 'G&A' END AS department",
                "CASE WHEN user_id % 8 = 0 THEN 'COGS' ELSE 'OPEX' END AS cost_center",
                "CASE WHEN user_id % 8 = 0 THEN '5300' WHEN user_id % 4 = 0 THEN '6000' "
                "WHEN user_id % 4 = 1 THEN '6010' WHEN user_id % 4 = 2 THEN '6020' ELSE '6030' END AS salary_account",
                f"CASE WHEN user_id % 50 = 7 THEN NULL ELSE 'Role ' || {_text('user_id % 5')} END AS role",
                "cast(50000 + (user_id * 997) % 60000 AS decimal(15,2)) AS salary",
                "date_add(date'1994-01-01', cast(user_id % 365 AS int)) AS hire_date",
                "true AS is_active",
                "date'1995-01-01' AS created_at",
                f"CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'E' || {_text('user_id - user_id % 10')} END AS manager_id",
            )
        )

    @cached_property
    def raw_vendors(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                f"'V' || {_text('s_suppkey')} AS vendor_id",
                "s_name AS vendor_name",
                "n_name AS vendor_category",
                "cast(15 * (s_suppkey % 4) AS int) AS payment_terms_days",
                "CASE s_suppkey % 7 WHEN 0 THEN '5000' WHEN 1 THEN '5100' WHEN 2 THEN '6100' WHEN 3 THEN '6200' "
                "WHEN 4 THEN '6300' ELSE '6400' END AS expense_account_code",
                "true AS is_active",
                "date'1994-12-01' AS created_at",
            )
        )

    @cached_property
    def raw_subscriptions(self) -> DataFrame:
        spans = (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("k"))
            .agg(
                F.min("o_orderdate").cast("date").alias("first_day"),
                F.max("o_orderdate").cast("date").alias("last_day"),
            )
            .selectExpr("k", "CASE WHEN k % 3 = 0 THEN last_day ELSE first_day END AS start_date")
        )
        return spans.selectExpr(
            f"'S' || {_text('k')} AS subscription_id",
            f"'C' || {_text('k')} AS customer_id",
            f"'P' || {_text('k % 100')} AS product_id",
            f"'Plan ' || {_text('k % 5')} AS plan_name",
            "CASE WHEN k % 25 = 0 THEN 'churned ' WHEN k % 5 = 0 THEN 'Churned' WHEN k % 27 = 0 THEN 'ACTIVE' "
            "ELSE 'Active' END AS status",
            "cast(99 + (k % 25) * 100 AS decimal(15,2)) AS mrr",
            "start_date",
            "CASE WHEN k % 5 = 0 THEN date_add(start_date, cast(30 + k % 400 AS int)) "
            "WHEN k % 7 = 0 THEN date'2001-09-30' END AS end_date",
            "start_date AS created_at",
            "date'2001-08-01' AS updated_at",
        )

    @cached_property
    def raw_invoices(self) -> DataFrame:
        day = "cast(o_orderdate AS date)"
        return (
            self.table("orders")
            .withColumn(
                "st",
                F.expr("CASE o_orderkey % 8 WHEN 7 THEN 'Open' WHEN 6 THEN 'Overdue' ELSE 'Paid' END"),
            )
            .selectExpr(
                f"'I' || {_text('o_orderkey')} AS invoice_id",
                f"'C' || {_text('o_custkey')} AS customer_id",
                f"CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'S' || {_text('o_custkey')} END AS subscription_id",
                f"'E' || {_text('o_orderkey % 40')} AS sales_rep_id",
                "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Professional Services' ELSE 'Subscription' END AS invoice_type",
                f"{day} AS invoice_date",
                f"date_add({day}, 30) AS due_date",
                "CASE WHEN o_orderkey % 25 = 0 THEN lower(st) WHEN o_orderkey % 26 = 0 THEN upper(st) "
                "WHEN o_orderkey % 27 = 0 THEN st || ' ' ELSE st END AS status",
                "cast(o_totalprice AS decimal(15,2)) AS total_amount",
                "CASE WHEN o_orderkey % 50 = 0 THEN 'usd' ELSE 'USD' END AS currency",
                f"{day} AS created_at",
            )
        )

    @cached_property
    def raw_invoice_lines(self) -> DataFrame:
        price = "cast(900 + l_partkey % 1000 AS decimal(15,2))"
        parts = " || '-' || ".join(
            _text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        )
        return self.table("lineitem").selectExpr(
            f"'L' || {parts} AS line_id",
            f"'I' || {_text('l_orderkey')} AS invoice_id",
            f"'P' || {_text('l_partkey')} AS product_id",
            "CASE WHEN l_orderkey % 33 = 0 THEN '  Line item' ELSE 'Line item' END AS description",
            "cast(l_quantity AS int) AS quantity",
            f"{price} AS unit_price",
            "cast(round(l_discount * 100, 2) AS decimal(6,4)) AS discount_pct",
            f"cast(cast(l_quantity AS int) * {price} * (1 - cast(l_discount AS decimal(4,2))) AS decimal(15,2)) AS line_total",
        )

    @cached_property
    def raw_payments(self) -> DataFrame:
        number = "cast(substr(invoice_id, 2) AS bigint)"
        return (
            self.raw_invoices.filter("lower(trim(status)) = 'paid'")
            .selectExpr(
                "'R' || substr(invoice_id, 2) AS payment_id",
                "invoice_id",
                "customer_id",
                f"date_add(invoice_date, cast(3 + {number} % 30 AS int)) AS payment_date",
                "total_amount AS amount",
                f"CASE {number} % 5 WHEN 0 THEN 'ACH' WHEN 1 THEN 'Wire' WHEN 2 THEN 'Credit Card' "
                "WHEN 3 THEN 'Check' ELSE 'ach ' END AS payment_method",
                "currency",
                "invoice_date AS created_at",
            )
        )

    @cached_property
    def raw_vendor_bills(self) -> DataFrame:
        spend = (
            self.table("lineitem")
            .groupBy(
                F.col("l_suppkey").alias("k"),
                F.trunc(F.col("l_shipdate").cast("date"), "month").alias("m"),
            )
            .agg(F.sum(F.expr("cast(l_extendedprice AS decimal(15,2))")).alias("shipped"))
        )
        vendors = self.raw_vendors.select("vendor_id", "vendor_name", "expense_account_code", "payment_terms_days")
        day = "date_add(m, cast(1 + k % 6 AS int))"
        return (
            spend.withColumn("vendor_id", F.expr(f"'V' || {_text('k')}"))
            .join(vendors, "vendor_id")
            .selectExpr(
                f"'B' || {_text('k')} || '-' || {_text('m')} AS bill_id",
                "vendor_id",
                "'A' || expense_account_code AS expense_account_id",
                f"{day} AS bill_date",
                f"date_add({day}, payment_terms_days) AS due_date",
                "cast(shipped * 0.25 AS decimal(15,2)) AS amount",
                "CASE WHEN (k + month(m)) % 10 = 0 THEN 'Open' WHEN (k + month(m)) % 31 = 0 THEN 'paid ' "
                "ELSE 'Paid' END AS status",
                f"vendor_name || ' -- ' || {_text('m')} AS description",
                "CASE WHEN k % 50 = 0 THEN 'usd' ELSE 'USD' END AS currency",
                f"{day} AS created_at",
            )
        )

    @cached_property
    def order_months(self) -> Column:
        """Distinct order months as one array-valued scalar subquery (at most 12 per year)."""
        months = self.table("orders").select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("m"))
        return months.agg(F.array_sort(F.collect_set("m"))).scalar()

    @cached_property
    def raw_payroll(self) -> DataFrame:
        # All employees fit a small file, which one task would expand by itself.
        employees = self.raw_employees.select("employee_id", "department", "cost_center", "salary_account", "salary").repartition(
            self.spark.sparkContext.defaultParallelism, "employee_id"
        )
        monthly = employees.withColumn("months", self.order_months).selectExpr(
            "employee_id",
            "department",
            "cost_center",
            "salary_account",
            "explode(months) AS m",
            "cast(salary / 12 AS decimal(15,2)) AS g",
        )
        quarter = "cast(g * 0.25 AS decimal(15,2))"
        pay = (
            "struct(g AS gross_pay, {q} AS tax_withheld, date_add(last_day(m), 2) AS payment_date, 'Salary' AS pay_type)"
        ).format(q=quarter)
        bonus = (
            "struct({q} AS gross_pay, cast({q} * 0.37 AS decimal(15,2)) AS tax_withheld, "
            "last_day(m) AS payment_date, 'bonus ' AS pay_type)"
        ).format(q=quarter)
        # One pass over the employee-months: December rows yield a second, bonus row.
        return (
            monthly.selectExpr(
                "employee_id",
                "department",
                "cost_center",
                "salary_account",
                "m",
                f"inline(CASE WHEN month(m) = 12 THEN array({pay}, {bonus}) ELSE array({pay}) END)",
            )
            .selectExpr(
                f"'Y' || employee_id || '-' || {_text('m')} || '-' || upper(trim(pay_type)) AS payroll_id",
                "employee_id",
                "department",
                "cost_center",
                "salary_account",
                "m AS pay_period_start",
                "last_day(m) AS pay_period_end",
                "gross_pay",
                "tax_withheld",
                "cast(gross_pay - tax_withheld AS decimal(15,2)) AS net_pay",
                "payment_date",
                "pay_type",
                "last_day(m) AS created_at",
            )
        )

    @cached_property
    def raw_journal_entries(self) -> DataFrame:
        return posting.build_journal(
            self.raw_invoices,
            self.raw_payments,
            self.raw_vendor_bills,
            self.raw_payroll,
            self.raw_chart_of_accounts,
        )

    def all(self) -> dict[str, DataFrame]:
        """Every raw table by name."""
        from ledgermill.schemas import RAW_TABLES

        return {name: getattr(self, name) for name in RAW_TABLES}
