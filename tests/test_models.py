"""What the registered queries store, and what they read where it is."""

import os

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import quality
from ledgermill.plans import catalog, serving
from ledgermill.session import RUNTIME_CONF, scratch_path
from ledgermill.sources import raw, sinks
from ledgermill.sources.fixtures import RawTables
from tests.conftest import SMALL, as_list, as_set


@pytest.fixture
def fresh(spark):
    """Models of the same tables by another path, of which none is stored."""
    catalog.Models(spark, SMALL)
    found = catalog.Models(spark, f"{SMALL}//")
    for key in [k for k in catalog._STORED if k[1] == found.sf_dir]:
        del catalog._STORED[key]
    return found


def stored(models):
    return {key[3] for key in catalog._STORED if key[1] == models.sf_dir}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_pass_over_the_ledger_stores_no_ledger(fresh, models):
    models.fact_journal_entries  # stored there, so read
    assert as_list(catalog.QUERIES["gl_unbalanced_refs"](fresh)) == as_list(catalog.QUERIES["gl_unbalanced_refs"](models))
    for name in ("kpis_cash_balance", "cash_flow", "cash_flow_summary"):
        assert as_list(catalog.QUERIES[name](fresh)) == as_list(catalog.QUERIES[name](models))
    assert not {"raw_journal_entries", "fact_journal_entries"} & stored(fresh)
    assert as_list(fresh.fact_journal_entries) == as_list(models.fact_journal_entries)
    assert "raw_journal_entries" not in stored(fresh) and "fact_journal_entries" in stored(fresh)


def test_receivables_read_open_invoices_and_few_columns(models):
    for query in (serving.ar_aging, serving.ar_aging_by_segment):
        text = plan(query(models.rpt_ar_aging))
        assert "billing_email" not in text and "company_name" not in text and "NOT is_paid_invoice" in text
    assert "rpt_ar_aging" not in stored(models)


def test_unique_builds_the_models_that_have_a_rule(fresh):
    found = catalog.QUERIES["dq_unique"](fresh)
    assert {r.model for r in found.select("model").collect()} == set(quality.UNIQUE)
    assert not {"fact_invoices", "rpt_revenue_summary", "rpt_ar_aging", "rpt_payroll_burn"} & stored(fresh)


def test_projections_are_not_copied_and_their_rules_are_counted(fresh, rows):
    names = ["stg_invoices", "stg_invoice_lines", "stg_payments", "stg_products", "stg_customers"]
    watches = fresh.watched(names)
    assert stored(fresh) == {"stg_customers"}
    want = quality.check_not_null({n: fresh.by_name()[n] for n in names})
    assert as_set(quality.watched_not_null(fresh.spark, watches)) == as_set(want)
    df = rows("payroll_id string, employee_id string, pay_type string", "('p', 'e', 'SALARY'), (NULL, 'e', 'x'), (NULL, NULL, NULL)")
    assert quality.counted(df, "fact_payroll") == quality.Watch("fact_payroll", {"payroll_id": 2, "employee_id": 1}, {"pay_type": 1})
    assert quality.counted(df.limit(0), "fact_payroll").nulls == {"payroll_id": 0, "employee_id": 0}
    assert quality.counted(df, "rpt_mrr") == quality.Watch("rpt_mrr", {}, {})


def test_stored_models_are_packed_and_read_in_small_pieces(fresh):
    files = fresh.dim_customers.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") or f.endswith(".zst.parquet") for f in files)
    assert RUNTIME_CONF["spark.sql.files.maxPartitionBytes"] == "32m" == fresh.spark.conf.get("spark.sql.files.maxPartitionBytes")


def test_payroll_is_expanded_by_all_tasks(spark):
    payroll = RawTables(spark, SMALL).raw_payroll
    assert "REPARTITION_BY_NUM" in plan(payroll)
    assert payroll.select(F.spark_partition_id()).distinct().count() > 1


def test_compressed_csv_comes_back(spark, models):
    path, customers = scratch_path(spark, "packed.csv"), models.stg("raw_customers").withColumn("company_name", F.lit('a "b", c'))
    sinks.write_csv(customers, path, "lz4")
    assert {f.rsplit(".", 1)[1] for f in os.listdir(path) if f.startswith("part-")} == {"lz4"}
    assert as_list(raw.read_raw_csv(spark, path, "raw_customers")) == as_list(customers)
