"""Cleaned and typed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.columns import clean_upper


def dim_accounts(stg: DataFrame) -> DataFrame:
    return stg.select(
        "account_id",
        F.col("account_code").cast("int").alias("account_code"),
        clean_upper("account_name").alias("account_name"),
        clean_upper("account_type").alias("account_type"),
        clean_upper("account_subtype").alias("account_subtype"),
        "is_active",
    )


def dim_customers(stg: DataFrame) -> DataFrame:
    """Company name stays as loaded; only a NULL industry or region becomes UNKNOWN."""

    def known(c: str):
        return F.upper(F.coalesce(F.trim(c), F.lit("Unknown"))).alias(c)

    return stg.select(
        "customer_id",
        "company_name",
        known("industry"),
        F.upper("segment").alias("segment"),
        known("region"),
        F.upper("billing_email").alias("billing_email"),
        F.upper(F.split_part("billing_email", F.lit("@"), F.lit(2))).alias("email_domain"),
        "credit_limit",
        F.col("created_at").cast("date").alias("created_at"),
        "is_active",
    )


def dim_employees(stg: DataFrame) -> DataFrame:
    """Employees with their manager's name and role.

    ``full_name`` joins the names as loaded, before cleaning. The manager side
    carries three columns only; when many employees share one manager the
    adaptive join splits the employee side.
    """
    people = stg.select(
        "employee_id",
        clean_upper("first_name").alias("first_name"),
        clean_upper("last_name").alias("last_name"),
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
        clean_upper("department").alias("employee_department"),
        clean_upper("role").alias("employee_role"),
        "salary",
        F.col("hire_date").cast("date").alias("hire_date"),
        "is_active",
        F.col("created_at").cast("date").alias("created_at"),
        "manager_id",
    )
    managers = people.select(
        F.col("employee_id").alias("manager_id"),
        F.col("full_name").alias("manager_name"),
        F.col("employee_role").alias("manager_role"),
    )
    return people.join(managers, "manager_id", "left").select(*people.columns, "manager_name", "manager_role")


def dim_products(stg: DataFrame) -> DataFrame:
    return stg.select(
        "product_id",
        clean_upper("product_name").alias("product_name"),
        clean_upper("product_category").alias("product_category"),
        "unit_price",
        clean_upper("description").alias("product_description"),
        "is_active",
        F.col("created_at").cast("date").alias("created_at"),
    )


def dim_vendors(stg: DataFrame) -> DataFrame:
    return stg.select(
        "vendor_id",
        clean_upper("vendor_name").alias("vendor_name"),
        clean_upper("vendor_category").alias("vendor_category"),
        F.col("payment_terms_days").cast("int").alias("payment_terms_days"),
        F.col("expense_account_code").cast("int").alias("expense_account_code"),
        "is_active",
        F.col("created_at").cast("date").alias("created_at"),
    )
