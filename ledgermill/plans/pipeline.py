"""The model graph, lazily chained or stored layer by layer."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.columns import as_doubles, with_audit
from ledgermill.operators import bronze, dims, facts, posting, quality
from ledgermill.plans import marts, statements
from ledgermill.schemas import LOAD_KEYS, bronze_name
from ledgermill.session import path_exists, read_text, write_text
from ledgermill.sources import keyed_tables
from ledgermill.sources.sinks import current_version, load_replace

# Year columns that partition the stored tables which have one.
PARTITION_BY = {
    "fact_invoices": "invoice_year",
    "fact_journal_entries": "entry_year",
    "fact_payroll": "pay_year",
    "fact_vendor_bills": "bill_year",
    "rpt_ar_aging": "invoice_year",
    "rpt_revenue_summary": "invoice_year",
    "rpt_opex_by_vendor": "bill_year",
    "rpt_payroll_burn": "pay_year",
}


def bronze_models(raw: dict[str, DataFrame], load_ts: str | None = None) -> dict[str, DataFrame]:
    """Staged form of every raw table."""
    return {bronze_name(t): bronze.stage(df, t, load_ts) for t, df in raw.items()}


def silver_models(stg: dict[str, DataFrame], as_of: str) -> dict[str, DataFrame]:
    """Dimensions and facts over the staged tables."""
    accounts = dims.dim_accounts(stg["stg_chart_of_accounts"])
    return {
        "dim_accounts": accounts,
        "dim_customers": dims.dim_customers(stg["stg_customers"]),
        "dim_employees": dims.dim_employees(stg["stg_employees"]),
        "dim_products": dims.dim_products(stg["stg_products"]),
        "dim_vendors": dims.dim_vendors(stg["stg_vendors"]),
        "fact_invoices": facts.fact_invoices(stg["stg_invoices"], stg["stg_invoice_lines"], as_of),
        "fact_journal_entries": facts.fact_journal_entries(stg["stg_journal_entries"], accounts, as_of),
        "fact_payments": facts.fact_payments(stg["stg_payments"]),
        "fact_payroll": facts.fact_payroll(stg["stg_payroll"]),
        "fact_subscriptions": facts.fact_subscriptions(stg["stg_subscriptions"], as_of),
        "fact_vendor_bills": facts.fact_vendor_bills(stg["stg_vendor_bills"], as_of),
    }


def gold_models(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Report tables over stored silver tables."""
    accounts, customers, employees = silver["dim_accounts"], silver["dim_customers"], silver["dim_employees"]
    amounts = statements.ledger_months_from_fact(silver["fact_journal_entries"])
    return {
        "rpt_pl_statement": statements.rpt_pl_statement(amounts, accounts),
        "rpt_balance_sheet": statements.rpt_balance_sheet(amounts, accounts),
        "rpt_cash_flow": statements.rpt_cash_flow(silver["fact_journal_entries"]),
        "rpt_mrr": marts.rpt_mrr(silver["fact_subscriptions"], customers, silver["dim_products"]),
        "rpt_revenue_summary": marts.rpt_revenue_summary(silver["fact_invoices"], customers, employees),
        "rpt_ar_aging": marts.rpt_ar_aging(silver["fact_invoices"], customers),
        "rpt_opex_by_vendor": marts.rpt_opex_by_vendor(silver["fact_vendor_bills"], silver["dim_vendors"], accounts),
        "rpt_payroll_burn": marts.rpt_payroll_burn(silver["fact_payroll"], employees),
    }


def posted_journal(stg: dict[str, DataFrame]) -> DataFrame:
    """The general ledger posted from staged tables."""
    return posting.build_journal(
        stg["stg_invoices"],
        stg["stg_payments"],
        stg["stg_vendor_bills"],
        posting.with_salary_account(stg["stg_payroll"]),
        stg["stg_chart_of_accounts"],
    )


def load_bronze(
    spark: SparkSession, raw: dict[str, DataFrame], root: str, load_ts: str, restamp: bool = False
) -> dict[str, DataFrame]:
    """Create every staged table below ``root``, or bring it up to its source, and return their current rows.

    Rows are compared by digest and only those of new or changed keys are written, so a
    row's ``ingestion_timestamp`` is that of the load that last changed it. With
    ``restamp`` every load replaces all rows of its keys, whether they changed or not.
    """
    current = {}
    stamp = {"ingestion_timestamp": F.lit(load_ts).cast("timestamp")}
    for table, df in raw.items():
        name, path = bronze_name(table), f"{root}/bronze/{bronze_name(table)}"
        if not restamp:
            keyed_tables.load_changes(spark, path, bronze.stage(df, table), LOAD_KEYS[table], stamp)
        elif keyed_tables.table_exists(spark, path):
            keyed_tables.upsert_table(spark, path, bronze.stage(df, table, load_ts), LOAD_KEYS[table])
        else:  # everything is new: nothing to read and to compare
            keyed_tables.create_table(bronze.stage(df, table, load_ts), path, LOAD_KEYS[table])
        current[name] = keyed_tables.read_table(spark, path)
    return current


# What each model is built from; a model is stale if one of these has another version than when it was built.
DEPENDS = {
    "dim_accounts": ("stg_chart_of_accounts",),
    "dim_customers": ("stg_customers",),
    "dim_employees": ("stg_employees",),
    "dim_products": ("stg_products",),
    "dim_vendors": ("stg_vendors",),
    "fact_invoices": ("stg_invoices", "stg_invoice_lines"),
    "fact_journal_entries": ("stg_journal_entries", "dim_accounts"),
    "fact_payments": ("stg_payments",),
    "fact_payroll": ("stg_payroll",),
    "fact_subscriptions": ("stg_subscriptions",),
    "fact_vendor_bills": ("stg_vendor_bills",),
    "rpt_pl_statement": ("fact_journal_entries", "dim_accounts"),
    "rpt_balance_sheet": ("fact_journal_entries", "dim_accounts"),
    "rpt_cash_flow": ("fact_journal_entries",),
    "rpt_mrr": ("fact_subscriptions", "dim_customers", "dim_products"),
    "rpt_revenue_summary": ("fact_invoices", "dim_customers", "dim_employees"),
    "rpt_ar_aging": ("fact_invoices", "dim_customers"),
    "rpt_opex_by_vendor": ("fact_vendor_bills", "dim_vendors", "dim_accounts"),
    "rpt_payroll_burn": ("fact_payroll", "dim_employees"),
}


class Built:
    """Which versions of its inputs every stored model was built from, a small file a model below ``root``.

    The file is written after the model's table shows the new load, so a build that is
    lost in between is done again.
    """

    def __init__(self, spark: SparkSession, root: str, as_of: str):
        self.spark, self.folder, self.as_of = spark, f"{root.rstrip('/')}/_built", as_of
        self.versions: dict[str, int] = {}

    def inputs(self, name: str) -> dict:
        return {"as_of": self.as_of, **{d: self.versions[d] for d in DEPENDS[name]}}

    def fresh(self, layer: str, name: str) -> bool:
        """Whether the stored model is what building it again would give."""
        place = f"{self.folder}/{name}.json"
        shown = current_version(self.spark, f"{layer}.{name}")
        if shown is None or not path_exists(self.spark, place):
            return False
        return json.loads(read_text(self.spark, place)) == {"version": shown, "inputs": self.inputs(name)}

    def done(self, name: str, version: int) -> None:
        write_text(self.spark, f"{self.folder}/{name}.json", json.dumps({"version": version, "inputs": self.inputs(name)}))


def store_models(
    spark: SparkSession, models: dict[str, DataFrame], layer: str, root: str, built: Built | None = None, only_stale: bool = False
) -> dict[str, DataFrame]:
    """Replace the stored table of every model, or of the stale ones, and return the stored tables.

    What the column rules of the models find is counted while they are written, and kept
    in ``<layer>.model_checks``.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    checks = []
    for name, df in models.items():
        table = f"{layer}.{name}"
        if not (only_stale and built is not None and built.fresh(layer, name)):
            watched, found = quality.watch(df, name)
            version = load_replace(watched, table, PARTITION_BY.get(name), f"{root}/{layer}/{name}")
            checks += [(name, c, "not null", n) for c, n in found().nulls.items()]
            checks += [(name, c, "accepted values", n) for c, n in found().unaccepted.items()]
            if built is not None:
                built.versions[name] = version
                built.done(name, version)
        elif built is not None:
            built.versions[name] = current_version(spark, table)
    _store_checks(spark, checks, layer, root)
    return {name: spark.table(f"{layer}.{name}") for name in models}


def _store_checks(spark: SparkSession, checks: list[tuple], layer: str, root: str) -> None:
    """Replace the counts of the models that were stored; those of others stay."""
    fresh = spark.createDataFrame(checks, "model string, column_name string, rule string, failures long")
    table = f"{layer}.model_checks"
    if current_version(spark, table) is not None:
        fresh = bronze.upsert(spark.table(table), fresh, ["model"])
    load_replace(fresh.coalesce(1), table, path=f"{root}/{layer}/model_checks")


def build_all(
    spark: SparkSession, raw: dict[str, DataFrame], root: str, as_of: str, load_ts: str, run_id: str, only_stale: bool = False
) -> dict[str, DataFrame]:
    """Load bronze, then rebuild silver and gold as stored tables; returns every stored model.

    Each layer reads the stored tables of the one before, so nothing is derived
    twice and a lost executor costs at most the running write. Without
    ``raw_journal_entries`` the ledger is posted from the staged tables. With
    ``only_stale`` a model is left as it is if its inputs have the versions that it was
    built from, for the same ``as_of``; a staged table gets a version only when a load
    changes rows. A build that was cut off then goes on where it stopped.
    """
    stg = load_bronze(spark, raw, root, load_ts)
    if "stg_journal_entries" not in stg:
        journal = {"raw_journal_entries": posted_journal(stg)}
        stg |= load_bronze(spark, journal, root, load_ts)
    built = Built(spark, root, as_of)
    built.versions = {name: keyed_tables.table_versions(spark, f"{root}/bronze/{name}")[-1] for name in stg}
    silver = {n: with_audit(df, load_ts, "silver_inserted_at") for n, df in silver_models(stg, as_of).items()}
    silver = store_models(spark, silver, "silver", root, built, only_stale)
    gold = {
        n: with_audit(as_doubles(df), load_ts, "_loaded_at", _run_id=run_id) for n, df in gold_models(silver).items()
    }
    return {**stg, **silver, **store_models(spark, gold, "gold", root, built, only_stale)}


def vacuum_all(spark: SparkSession, root: str, keep: int = 2, older_than_hours: float = 24.0) -> int:
    """Clear what no kept version of the staged tables needs; returns how many files went. Loads of silver and gold are dropped as they are replaced."""
    paths = [f"{root}/bronze/{bronze_name(t)}" for t in LOAD_KEYS]
    return sum(keyed_tables.vacuum_table(spark, p, keep, older_than_hours) for p in paths if keyed_tables.table_exists(spark, p))
