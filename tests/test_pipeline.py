from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill.plans import pipeline
from ledgermill.session import scratch_path
from ledgermill.sources import sinks
from ledgermill.sources.fixtures import AS_OF


def test_build_twice_gives_the_same_tables(spark, models):
    root = scratch_path(spark, "warehouse")
    raw = models.raw.all()
    del raw["raw_journal_entries"]  # posted from the staged tables
    first = pipeline.build_all(spark, raw, root, AS_OF, "2001-08-15 06:00:00", "run-1")
    counts = {n: df.count() for n, df in first.items()}
    assert counts["fact_journal_entries"] == 12271 and counts["rpt_pl_statement"] == 1360
    assert len(counts) == 12 + 11 + 8
    assert not any(c.startswith(("_digest", "_check")) for df in first.values() for c in df.columns)
    second = pipeline.build_all(spark, raw, root, AS_OF, "2001-08-16 06:00:00", "run-2")
    assert {n: df.count() for n, df in second.items()} == counts
    sheet = second["rpt_balance_sheet"]
    assert set(sheet.select("_run_id").distinct().toPandas()["_run_id"]) == {"run-2"}
    cash = sheet.filter("account_name = 'CASH AND CASH EQUIVALENTS' AND entry_month IS NULL").first()
    assert Decimal(str(cash.closing_balance)) == Decimal("206509926.24")
    lazy = models.rpt_pl_statement.select("entry_month", "account_name", "period_amount", "pct_of_revenue")
    stored = second["rpt_pl_statement"].select(*lazy.columns)
    assert stored.exceptAll(lazy.selectExpr("entry_month", "account_name", "cast(period_amount AS double)", "cast(pct_of_revenue AS double)")).count() == 0


def test_only_stale_models_are_built_again(spark, models):
    root = scratch_path(spark, "warehouse")
    raw = models.raw.all()
    del raw["raw_journal_entries"]

    def build(run_id, as_of=AS_OF, **changed):
        pipeline.build_all(spark, {**raw, **changed}, root, as_of, "2001-08-15 06:00:00", run_id, only_stale=True)
        shown = {n: sinks.current_version(spark, f"silver.{n}") for n in pipeline.silver_models(staged, as_of)}
        return shown | {n: sinks.current_version(spark, f"gold.{n}") for n in pipeline.DEPENDS if n.startswith("rpt_")}

    staged = {f"stg_{t.removeprefix('raw_')}": df for t, df in models.raw.all().items()}
    first = build("run-1")
    assert build("run-2") == first  # nothing changed
    vendors = raw["raw_vendors"].withColumn("vendor_name", F.concat("vendor_name", F.lit("!")))
    third = build("run-3", raw_vendors=vendors)
    assert {n for n in first if third[n] != first[n]} == {"dim_vendors", "rpt_opex_by_vendor"}
    assert spark.table("gold.rpt_opex_by_vendor").filter("vendor_name LIKE '%!'").count() > 0
    # Another day makes the models stale that are given it.
    assert build("run-4", as_of="2001-08-16", raw_vendors=vendors) != third
    # What the rules found was counted while the models were written.
    checks = spark.table("silver.model_checks")
    assert checks.filter("model = 'fact_journal_entries' AND column_name = 'entry_id'").first().failures == 11
    assert pipeline.vacuum_all(spark, root, keep=1, older_than_hours=0) > 0
