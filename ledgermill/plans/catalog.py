"""Every registered query over one test-data folder.

``Models`` chains raw -> staged -> silver -> gold. A model that others read is stored
once in the shared folder when first used, as a warehouse would, and every later query
of the session reads the stored table. ``QUERIES`` maps a query name to a function of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgermill.functions.columns import as_doubles, with_audit
from ledgermill.functions.frames import union_all
from ledgermill.operators import bronze, dims, facts, posting, quality, schedules
from ledgermill.operators.bitmaps import ID
from ledgermill.operators.intervals import interval_join, interval_totals
from ledgermill.operators.prefix import dense_ids
from ledgermill.plans import annual, marts, serving, statements
from ledgermill.plans.pipeline import load_bronze, posted_journal
from ledgermill.schemas import LOAD_KEYS, RAW_TABLES, bronze_name, raw_schemas
from ledgermill.session import discard, fingerprint, path_exists, scratch_path, tune
from ledgermill.sources import keyed_tables
from ledgermill.sources import raw as readers
from ledgermill.sources import sinks
from ledgermill.sources.fixtures import AS_OF, TABLES, RawTables
from ledgermill.streaming.upserts import (
    dedupe_counts,
    kept_rows,
    late_rows,
    latest_rows,
    read_file_stream,
    stream_dedupe,
    stream_upsert,
)

FIRST_YEAR, LAST_YEAR = 1995, 2001
PERIOD_START, PERIOD_END = "1995-01-01", "2001-08-31"


# Stored models of this process: (application, state of the input files, model) -> path, schema and what its rules found.
_STORED: dict[tuple, tuple[str, StructType, quality.Watch]] = {}
# What the rules of models that are not stored found, by the same key.
_COUNTED: dict[tuple, quality.Watch] = {}


def forget_stored(spark: SparkSession | None = None) -> None:
    """Build every stored model anew when it is next used; with a session, delete what its own have stored."""
    for key, (path, _, _) in _STORED.items():
        if spark is not None and key[0] == spark.sparkContext.applicationId:
            discard(spark, path.rsplit("/", 1)[0])
    _STORED.clear()
    _COUNTED.clear()


class StoredRaw(RawTables):
    """Raw tables of which those that are derived by an aggregation or a posting are stored."""

    def __init__(self, spark: SparkSession, sf_dir: str, keep: Callable[[str, Callable[[], DataFrame]], DataFrame]):
        super().__init__(spark, sf_dir)
        self.keep = keep

    @cached_property
    def raw_employees(self) -> DataFrame:
        return self.keep("raw_employees", lambda: RawTables(self.spark, self.sf_dir).raw_employees)

    @cached_property
    def raw_vendor_bills(self) -> DataFrame:
        return self.keep("raw_vendor_bills", lambda: RawTables(self.spark, self.sf_dir).raw_vendor_bills)

    @cached_property
    def raw_payroll(self) -> DataFrame:
        return self.keep("raw_payroll", lambda: RawTables.raw_payroll.func(self))

    @cached_property
    def raw_journal_entries(self) -> DataFrame:
        return self.keep("raw_journal_entries", self.posted)

    def posted(self) -> DataFrame:
        """The ledger posted from the staged tables as it is read."""
        tables = ("invoices", "payments", "vendor_bills", "payroll", "chart_of_accounts")
        return posted_journal({f"stg_{t}": bronze.stage(getattr(self, f"raw_{t}"), f"raw_{t}") for t in tables})


class Models:
    """Models over one folder; each is built, and if others read it stored, on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        self.raw = StoredRaw(spark, sf_dir, self.keep)

    @cached_property
    def state(self) -> tuple:
        """What tells one content of the input folder from another: every file's name, length and time."""
        return tuple(fingerprint(self.spark, f"{self.sf_dir}/{t}.parquet") for t in TABLES)

    def key(self, name: str) -> tuple:
        return self.spark.sparkContext.applicationId, self.sf_dir, self.state, name

    def is_stored(self, name: str) -> bool:
        return self.key(name) in _STORED and path_exists(self.spark, _STORED[self.key(name)][0])

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored model ``name``; the first use in a session stores it, and counts what its column rules find."""
        key = self.key(name)
        if not self.is_stored(name):
            path = scratch_path(self.spark, name)
            # A raw table that is stored has the columns of the staged one.
            df, found = quality.watch(build(), name, bronze_name(name) if name.startswith("raw_") else None)
            df.write.option("compression", "zstd").parquet(path)
            _STORED[key] = (path, df.schema, found())
        path, schema, _ = _STORED[key]
        return self.spark.read.schema(schema).parquet(path)

    def stg(self, table: str) -> DataFrame:
        if table in STORED_RAW + PROJECTED_RAW:
            return bronze.stage(getattr(self.raw, table), table)
        return self.keep(bronze_name(table), lambda: bronze.stage(getattr(self.raw, table), table))

    def watched(self, names: list[str]) -> dict[str, quality.Watch]:
        """What the rules of the named models found when these were stored; one that is a projection is scanned for it."""
        found = {}
        for name in names:
            if STAGED.get(name) in PROJECTED_RAW:
                if self.key(name) not in _COUNTED:
                    _COUNTED[self.key(name)] = quality.counted(self.stg(STAGED[name]), name)
                found[name] = _COUNTED[self.key(name)]
                continue
            stored = STAGED[name] if STAGED.get(name) in STORED_RAW else name
            self.stg(STAGED[name]) if name in STAGED else getattr(self, name)
            found[name] = _STORED[self.key(stored)][2]
        return found

    @property
    def journal(self) -> DataFrame:
        """The staged ledger for one pass of a reader: the stored one if there is one, else posted as it is read.

        Posting is a projection of stored tables, of which a reader of accounts and amounts
        builds no texts; storing all legs for it would cost far more than its pass.
        """
        raw = self.raw.raw_journal_entries if self.is_stored("raw_journal_entries") else self.raw.posted()
        return bronze.stage(raw, "raw_journal_entries")

    @property
    def booked(self) -> DataFrame:
        """``fact_journal_entries`` for one pass of a reader."""
        if self.is_stored("fact_journal_entries"):
            return self.fact_journal_entries
        return facts.fact_journal_entries(self.journal, self.dim_accounts, AS_OF)

    @cached_property
    def dim_accounts(self) -> DataFrame:
        return self.keep("dim_accounts", lambda: dims.dim_accounts(self.stg("raw_chart_of_accounts")))

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self.keep("dim_customers", lambda: dims.dim_customers(self.stg("raw_customers")))

    @cached_property
    def dim_employees(self) -> DataFrame:
        return self.keep("dim_employees", lambda: dims.dim_employees(self.stg("raw_employees")))

    @cached_property
    def dim_products(self) -> DataFrame:
        return self.keep("dim_products", lambda: dims.dim_products(self.stg("raw_products")))

    @cached_property
    def dim_vendors(self) -> DataFrame:
        return self.keep("dim_vendors", lambda: dims.dim_vendors(self.stg("raw_vendors")))

    @cached_property
    def fact_invoices(self) -> DataFrame:
        return self.keep(
            "fact_invoices", lambda: facts.fact_invoices(self.stg("raw_invoices"), self.stg("raw_invoice_lines"), AS_OF)
        )

    @cached_property
    def fact_journal_entries(self) -> DataFrame:
        return self.keep(
            "fact_journal_entries",
            lambda: facts.fact_journal_entries(self.journal, self.dim_accounts, AS_OF),
        )

    @cached_property
    def fact_payments(self) -> DataFrame:
        return self.keep("fact_payments", lambda: facts.fact_payments(self.stg("raw_payments")))

    @cached_property
    def fact_payroll(self) -> DataFrame:
        return self.keep("fact_payroll", lambda: facts.fact_payroll(self.stg("raw_payroll")))

    @cached_property
    def fact_subscriptions(self) -> DataFrame:
        return self.keep("fact_subscriptions", lambda: facts.fact_subscriptions(self.stg("raw_subscriptions"), AS_OF))

    @cached_property
    def audited_vendor_bills(self) -> DataFrame:
        """The one model of which a rule names the load time."""
        build = lambda: with_audit(facts.fact_vendor_bills(self.stg("raw_vendor_bills"), AS_OF), AS_OF, "silver_inserted_at")
        return self.keep("fact_vendor_bills", build)

    @cached_property
    def fact_vendor_bills(self) -> DataFrame:
        return self.audited_vendor_bills.drop("silver_inserted_at")

    @cached_property
    def ledger_months(self) -> DataFrame:
        return self.keep("ledger_months", lambda: statements.ledger_months(self.journal, self.dim_accounts))

    @cached_property
    def rpt_pl_statement(self) -> DataFrame:
        return self.keep("rpt_pl_statement", lambda: statements.rpt_pl_statement(self.ledger_months, self.dim_accounts))

    @cached_property
    def rpt_balance_sheet(self) -> DataFrame:
        return self.keep("rpt_balance_sheet", lambda: statements.rpt_balance_sheet(self.ledger_months, self.dim_accounts))

    @cached_property
    def rpt_cash_flow(self) -> DataFrame:
        return self.keep("rpt_cash_flow", lambda: statements.rpt_cash_flow(self.booked))

    @cached_property
    def rpt_mrr(self) -> DataFrame:
        return self.keep("rpt_mrr", lambda: marts.rpt_mrr(self.fact_subscriptions, self.dim_customers, self.dim_products))

    @cached_property
    def rpt_revenue_summary(self) -> DataFrame:
        return self.keep(
            "rpt_revenue_summary",
            lambda: marts.rpt_revenue_summary(self.fact_invoices, self.dim_customers, self.dim_employees),
        )

    @cached_property
    def rpt_ar_aging(self) -> DataFrame:
        """A view: a row per invoice line, of which a query reads a few columns and the open invoices."""
        return marts.rpt_ar_aging(self.fact_invoices, self.dim_customers)

    @cached_property
    def rpt_opex_by_vendor(self) -> DataFrame:
        return self.keep(
            "rpt_opex_by_vendor",
            lambda: marts.rpt_opex_by_vendor(self.fact_vendor_bills, self.dim_vendors, self.dim_accounts),
        )

    @cached_property
    def rpt_payroll_burn(self) -> DataFrame:
        return self.keep("rpt_payroll_burn", lambda: marts.rpt_payroll_burn(self.fact_payroll, self.dim_employees))

    @cached_property
    def revenue_bitmaps(self) -> DataFrame:
        ids = self.keep("customer_ids", lambda: dense_ids(self.rpt_revenue_summary, "customer_id", ID))
        return self.keep("revenue_bitmaps", lambda: serving.revenue_bitmaps(self.rpt_revenue_summary, ids))

    @cached_property
    def payroll_bitmaps(self) -> DataFrame:
        ids = self.keep("employee_ids", lambda: dense_ids(self.rpt_payroll_burn, "employee_id", ID))
        return self.keep("payroll_bitmaps", lambda: serving.payroll_bitmaps(self.rpt_payroll_burn, ids))

    def by_name(self) -> Mapping[str, DataFrame]:
        """Every model the quality rules name."""
        return NamedModels(self, [*STAGED, *MODEL_NAMES])

    def staged(self) -> Mapping[str, DataFrame]:
        return NamedModels(self, list(STAGED))


class NamedModels(Mapping):
    """Models by name, built only when looked up."""

    def __init__(self, models: Models, names: list[str]):
        self.models = models
        self.names = names

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        if name in STAGED:
            return self.models.stg(STAGED[name])
        return self.models.audited_vendor_bills if name == "fact_vendor_bills" else getattr(self.models, name)

    def __contains__(self, name: object) -> bool:
        return name in self.names

    def __iter__(self):
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


# Raw tables that are derived by more than a projection and stored as such.
STORED_RAW = ("raw_employees", "raw_vendor_bills", "raw_payroll", "raw_journal_entries")
# Raw tables that are a projection of one given table: read where they are, never copied.
PROJECTED_RAW = ("raw_products", "raw_invoices", "raw_invoice_lines", "raw_payments")
STAGED = {bronze_name(t): t for t in RAW_TABLES}
MODEL_NAMES = [
    "dim_accounts",
    "dim_customers",
    "dim_employees",
    "dim_products",
    "dim_vendors",
    "fact_invoices",
    "fact_journal_entries",
    "fact_payments",
    "fact_payroll",
    "fact_subscriptions",
    "fact_vendor_bills",
    "rpt_pl_statement",
    "rpt_balance_sheet",
    "rpt_cash_flow",
    "rpt_mrr",
    "rpt_revenue_summary",
    "rpt_ar_aging",
    "rpt_opex_by_vendor",
    "rpt_payroll_burn",
]

SERVING = {
    "kpis": "rpt_mrr",
    "kpis_gross_margin": "rpt_pl_statement",
    "kpis_cash_balance": "rpt_balance_sheet",
    "pnl": "rpt_pl_statement",
    "pnl_detail": "rpt_pl_statement",
    "mrr_trend": "rpt_revenue_summary",
    "mrr_by_plan": "rpt_mrr",
    "mrr_lifecycle": "rpt_mrr",
    "revenue_by_segment": "rpt_revenue_summary",
    "revenue_by_rep": "rpt_revenue_summary",
    "revenue_monthly": "rpt_revenue_summary",
    "ar_aging": "rpt_ar_aging",
    "ar_aging_by_segment": "rpt_ar_aging",
    "balance_sheet": "rpt_balance_sheet",
    "balance_sheet_latest": "rpt_balance_sheet",
    "cash_flow": "rpt_cash_flow",
    "cash_flow_summary": "rpt_cash_flow",
    "opex_vendor": "rpt_opex_by_vendor",
    "opex_vendor_monthly": "rpt_opex_by_vendor",
    "payroll": "rpt_payroll_burn",
    "payroll_annual": "rpt_payroll_burn",
}


# -- sources and sinks: written to a fresh shared path and read back ---------------


def csv_round_trip(m: Models, df: DataFrame, name: str, compression: str | None = None) -> str:
    path = scratch_path(m.spark, f"{name}.csv")
    sinks.write_csv(df, path, compression)
    return path


def awkward(df: DataFrame, column: str, key: str) -> DataFrame:
    """Some of the texts of a column with quotes, doubled quotes, commas, backslashes and line breaks."""
    kind = F.pmod(F.expr(f"cast(substr({key}, 2) AS bigint)"), F.lit(6))
    text = F.col(column)
    odd = (
        F.when(kind == 0, F.concat(text, F.lit(' "Best" Ltd')))
        .when(kind == 1, F.concat(F.lit('"'), text, F.lit('"')))
        .when(kind == 2, F.concat(text, F.lit(', \\ and "", too')))
        .when(kind == 3, F.concat(text, F.lit("\nline two")))
        .when(kind == 4, F.concat(text, F.lit("\\")))
    )
    return df.withColumn(column, odd.otherwise(text))


def q_read_raw_csv(m: Models) -> DataFrame:
    """A file whose columns come in another order than declared, with awkward texts."""
    customers = awkward(m.stg("raw_customers"), "company_name", "customer_id")
    path = csv_round_trip(m, customers.select(*reversed(customers.columns)), "raw_customers")
    return readers.read_raw_csv(m.spark, path, "raw_customers", multi_line=True)


def q_read_raw_csv_inferred(m: Models) -> DataFrame:
    customers = awkward(m.stg("raw_customers"), "company_name", "customer_id")
    return readers.read_raw_csv_inferred(m.spark, csv_round_trip(m, customers, "raw_customers"))


def _awkward_folder(m: Models) -> str:
    folder = scratch_path(m.spark, "csv")
    for table, (column, key) in {
        "raw_customers": ("company_name", "customer_id"),
        "raw_products": ("description", "product_id"),
        "raw_vendors": ("vendor_name", "vendor_id"),
    }.items():
        sinks.write_csv(awkward(m.stg(table), column, key), f"{folder}/{table}.csv")
    return folder


def _as_text(df: DataFrame, table: str) -> DataFrame:
    """Every value of every row in one text; money with two digits, so that it is the same in every engine."""
    cells = [
        F.coalesce(F.col(c).cast("decimal(15,2)" if kind == "double" else "string").cast("string"), F.lit("-")) for c, kind in df.dtypes
    ]
    return df.select(F.lit(table).alias("table_name"), F.concat_ws("|", *cells).alias("row_text"))


def q_read_csv_dir(m: Models) -> DataFrame:
    """Every value of the tables of a folder but the one that is skipped, as text."""
    tables = readers.read_csv_dir(m.spark, _awkward_folder(m), skip=("raw_vendors",))
    return union_all([_as_text(df, name) for name, df in tables.items()])


def q_load_csv_dir(m: Models) -> DataFrame:
    """Every file of a folder becomes a stored table, read back by name, every value as text."""
    folder = _awkward_folder(m)
    schema = "bronze_" + folder.split("/")[-2]
    tables = readers.load_csv_dir(m.spark, folder, schema, scratch_path(m.spark, "tables"), skip=("raw_customers",))
    assert sorted(tables) == ["raw_products", "raw_vendors"]
    products = readers.source(m.spark, schema, "raw_products")
    return union_all([_as_text(products, "raw_products"), _as_text(readers.ref(m.spark, "raw_vendors", schema), "raw_vendors")])


def _catalogued(m: Models) -> str:
    """A database that holds two of the raw tables under their names."""
    schema = "raw_" + scratch_path(m.spark, "x").split("/")[-2]
    m.spark.sql(f"CREATE DATABASE {schema}")
    for table in ("raw_customers", "raw_subscriptions"):
        sinks.load_replace(m.stg(table), f"{schema}.{table}", path=scratch_path(m.spark, table))
    return schema


def q_source(m: Models) -> DataFrame:
    return readers.source(m.spark, _catalogued(m), "raw_customers")


def q_ref(m: Models) -> DataFrame:
    return readers.ref(m.spark, "raw_subscriptions", _catalogued(m))


def q_raw_schemas(m: Models) -> DataFrame:
    """Declared columns of every raw table with how many values a reader finds in a compressed file of it."""
    parts = []
    for table, schema in raw_schemas().items():
        if table == "raw_chart_of_accounts":
            continue
        staged = m.journal if table == "raw_journal_entries" else m.stg(table)
        df = readers.read_raw_csv(m.spark, csv_round_trip(m, staged, table, "lz4"), table)
        cells = [
            F.struct(F.lit(f.name).alias("column_name"), F.lit(df.schema[f.name].dataType.simpleString()).alias("data_type"), F.col(f"n_{f.name}").alias("n"))
            for f in schema.fields
        ]
        counts = df.agg(*[F.count(f.name).alias(f"n_{f.name}") for f in schema.fields])
        parts.append(counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*cells))))
    return union_all(parts)


def q_write_csv(m: Models) -> DataFrame:
    """Awkward texts, written and read back."""
    path = csv_round_trip(m, awkward(m.stg("raw_invoices"), "status", "invoice_id"), "raw_invoices")
    return readers.read_raw_csv(m.spark, path, "raw_invoices", multi_line=None)


def _stored(m: Models, name: str, *loads: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Replace one stored table by each load in turn and read what remains by name."""
    path = scratch_path(m.spark, name)
    table = f"{name}_{path.rsplit('/', 2)[1]}"
    for df in loads:
        sinks.load_replace(df, table, partition_by, path)
    return readers.ref(m.spark, table)


def q_load_replace(m: Models) -> DataFrame:
    """The second load of a payments table is what remains."""
    return _stored(m, "payments", m.stg("raw_payments"), m.fact_payments)


def q_load_replace_simple(m: Models) -> DataFrame:
    """The same by path, without a table name."""
    path = scratch_path(m.spark, "payments")
    sinks.load_replace_simple(m.stg("raw_payments"), path)
    sinks.load_replace_simple(m.fact_payments, path)
    return m.spark.read.parquet(path)


def q_materialize_table(m: Models) -> DataFrame:
    """A mart rebuilt as a stored table, partitioned by year."""
    columns = m.fact_vendor_bills.columns
    return _stored(m, "fact_vendor_bills", m.fact_vendor_bills, partition_by="bill_year").select(*columns)


def q_materialize_incremental(m: Models) -> DataFrame:
    """A staged table loaded three times: as it first was, the same again, and with rows that are new or changed."""
    root, number = scratch_path(m.spark, "bronze"), F.expr("cast(substr(invoice_id, 2) AS bigint)")
    now = m.raw.raw_invoices
    was = now.filter(number % 50 != 7).withColumn("status", F.when(number % 20 == 3, "Draft").otherwise(F.col("status")))
    for raw, load_ts in ((was, "2001-08-13 06:00:00"), (was, "2001-08-14 06:00:00"), (now, "2001-08-15 06:00:00")):
        loaded = load_bronze(m.spark, {"raw_invoices": raw}, root, load_ts)
    assert keyed_tables.table_versions(m.spark, f"{root}/bronze/stg_invoices") == [1, 2]  # the second load wrote nothing
    return loaded["stg_invoices"]


# -- bronze -------------------------------------------------------------------------


def q_upsert(m: Models) -> DataFrame:
    """Bring paid invoices' statuses up to date: the batch replaces its keys, the rest survives."""
    target = m.stg("raw_invoices")
    batch = posting.select_paid_for_payment(target).withColumn("status", F.lit("Closed"))
    return bronze.upsert(target, batch, LOAD_KEYS["raw_invoices"])


def q_upsert_table(m: Models) -> DataFrame:
    """The stored form of the same upsert."""
    path, keys = scratch_path(m.spark, "stg_invoices"), LOAD_KEYS["raw_invoices"]
    target = m.stg("raw_invoices")
    keyed_tables.create_table(target, path, keys)
    batch = posting.select_paid_for_payment(target).withColumn("status", F.lit("Closed"))
    keyed_tables.upsert_table(m.spark, path, batch, keys)
    return keyed_tables.read_table(m.spark, path)


def q_upsert_table_as_of(m: Models) -> DataFrame:
    """Small batches of old and new keys on a table of many files: what each read and wrote, and the table at every version."""
    path, keys = scratch_path(m.spark, "stg_payments"), LOAD_KEYS["raw_payments"]
    payments = m.stg("raw_payments")
    number = F.expr("cast(substr(payment_id, 2) AS bigint)")
    keyed_tables.create_table(payments.filter(number % 40 != 1), path, keys, file_rows=2_000)
    for part in (0, 1):  # corrections, then late arrivals
        batch = payments.filter(number % 40 == part).withColumn("payment_method", F.lit(f"batch {part}"))
        keyed_tables.upsert_table(m.spark, path, batch, keys, file_rows=2_000)
    parts = [
        keyed_tables.read_table(m.spark, path, version).groupBy("payment_method").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
        .select(F.lit(version).alias("version"), "payment_method", "n", "amount")
        for version in keyed_tables.table_versions(m.spark, path)
    ]
    return union_all(parts)


def q_dedupe_latest(m: Models) -> DataFrame:
    events = m.raw.table("events").select("user_id", "ts", "event_id", "event_type", "value", "props")
    return bronze.dedupe_latest(events, ["user_id"], ["ts", "event_id"])


# -- streams ------------------------------------------------------------------------


def _feed(m: Models, folder: str, events: DataFrame, run: int) -> None:
    """Add the rows of one run to a folder of files."""
    events.filter(F.col("run") == run).drop("run").write.mode("append").parquet(folder)


def q_stream_upsert(m: Models) -> DataFrame:
    """Three out-of-order deliveries, the newest events first, with a restart after each."""
    folder, state = scratch_path(m.spark, "event_files"), scratch_path(m.spark, "state")
    events = m.raw.table("events")
    part = F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(3))
    for run in range(3):
        _feed(m, folder, events.withColumn("run", 2 - part), run)
        stream_upsert(read_file_stream(m.spark, folder, events.schema), ["user_id"], ["ts", "event_id"], state).awaitTermination()
    return latest_rows(m.spark, state, events.columns)


def _deduped(m: Models, events: DataFrame, runs: int, delay: str) -> tuple[str, StructType]:
    folder, path, state = (scratch_path(m.spark, n) for n in ("event_files", "events", "state"))
    schema = events.drop("run").schema
    for run in range(runs):
        _feed(m, folder, events, run)
        stream_dedupe(read_file_stream(m.spark, folder, schema), ["event_id"], "ts", delay, path, state).awaitTermination()
    return path, schema


def q_stream_dedupe(m: Models) -> DataFrame:
    """Every event sent twice in one delivery."""
    events = m.raw.table("events").withColumn("run", F.lit(0))
    path, schema = _deduped(m, events.unionByName(events), 1, "1 day")
    return kept_rows(m.spark, path, schema).select("event_id", "user_id", "event_type", "value", "props")


def q_stream_late(m: Models) -> DataFrame:
    """Three deliveries with stragglers and repeats: which rows are kept, which are late and by how much, how many repeat."""
    events = m.raw.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    run = F.expr(
        "CASE WHEN event_id % 10 = 3 THEN 2 WHEN ts < timestamp '2024-01-11' THEN 0 WHEN ts < timestamp '2024-01-21' THEN 1 ELSE 2 END"
    )
    first = events.withColumn("run", run)
    again = first.filter("event_id % 7 = 1").withColumn("run", F.least(F.col("run") + 1, F.lit(2)))
    path, schema = _deduped(m, first.unionByName(again), 3, "5 days")
    one = F.lit(1).cast("long").alias("n")
    kept = kept_rows(m.spark, path, schema).select(
        F.lit("kept").alias("outcome"), "event_id", F.lit(None).cast("double").alias("late_by_seconds"), one
    )
    late = late_rows(m.spark, path, schema).select(F.lit("late").alias("outcome"), "event_id", "late_by_seconds", one)
    repeated = dedupe_counts(m.spark, path).agg(F.sum("repeated").alias("n")).select(
        F.lit("repeated").alias("outcome"), F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("double").alias("late_by_seconds"), "n"
    )
    return kept.unionByName(late).unionByName(repeated)


# -- schedules ----------------------------------------------------------------------


def q_one_off_invoices(m: Models) -> DataFrame:
    milestones = m.raw.table("orders").filter("o_orderpriority = '1-URGENT'").selectExpr(
        "cast(o_orderkey AS string) AS milestone_id",
        "'C' || o_custkey AS customer_id",
        "'P' || (o_orderkey % 100) AS product_id",
        "cast(1 + o_orderkey % 2 AS int) AS quantity",
        "cast(o_orderdate AS date) AS milestone_date",
    )
    return schedules.one_off_invoices(milestones, m.stg("raw_products"))


def q_close_out_subscriptions(m: Models) -> DataFrame:
    subscriptions = m.stg("raw_subscriptions")
    churned = subscriptions.filter("lower(trim(status)) = 'churned'").select(
        "subscription_id", F.col("end_date").alias("churn_date")
    )
    return schedules.close_out_subscriptions(subscriptions, churned, "2001-08-31")


def _payroll_schedule(m: Models) -> DataFrame:
    number = "cast(substr(employee_id, 2) AS bigint)"
    employees = (
        m.stg("raw_employees")
        .withColumn("raise_rate", F.expr(f"cast(3 + {number} % 3 AS decimal(4,2)) / 100"))
        .withColumn("tax_rate", F.expr(f"cast(cast(22 + {number} % 11 AS decimal(4,2)) / 100 AS decimal(4,2))"))
    )
    return schedules.payroll_schedule(employees, FIRST_YEAR, FIRST_YEAR + 3, "raise_rate", "tax_rate")


def q_december_bonus(m: Models) -> DataFrame:
    return schedules.december_bonus(_payroll_schedule(m))


def q_account_code_lookup(m: Models) -> DataFrame:
    bills = m.stg("raw_vendor_bills").select("bill_id", "expense_account_id")
    return posting.account_code_lookup(bills, m.stg("raw_chart_of_accounts"), "expense_account_id", "account_code")


# -- yearly summaries ---------------------------------------------------------------


def q_annual_summary(m: Models) -> DataFrame:
    return annual.annual_summary(
        m.stg("raw_invoices"),
        m.stg("raw_payroll"),
        m.stg("raw_vendor_bills"),
        m.stg("raw_subscriptions"),
        m.stg("raw_journal_entries"),
        FIRST_YEAR,
        LAST_YEAR,
    )


def q_revenue_by_year_type(m: Models) -> DataFrame:
    """Five invoice types, among them one with a backtick and a dot and one called as the key."""
    number = F.expr("cast(substr(invoice_id, 2) AS bigint)")
    kind = F.when(number % 11 == 0, "Setup `one.off`").when(number % 13 == 0, "year").when(number % 17 == 0, F.lit(None).cast("string"))
    invoices = m.stg("raw_invoices").withColumn("invoice_type", F.when(number % 17 == 0, kind).otherwise(F.coalesce(kind, F.col("invoice_type"))))
    return annual.revenue_by_year_type(invoices)


def q_fact_invoices_bucketed(m: Models) -> DataFrame:
    """The fact over headers and lines that are stored in buckets by invoice: neither side moves."""
    return facts.fact_invoices(*bucketed_invoices(m), AS_OF)


def bucketed_invoices(m: Models) -> list[DataFrame]:
    stored = []
    for table in ("raw_invoices", "raw_invoice_lines"):
        path = scratch_path(m.spark, bronze_name(table))
        name = f"{bronze_name(table)}_{path.rsplit('/', 2)[1]}"
        sinks.load_replace(m.stg(table), name, path=path, bucket_by=["invoice_id"])
        stored.append(readers.ref(m.spark, name))
    return stored


def _asked_days(m: Models) -> DataFrame:
    return m.raw.table("orders").select(F.col("o_orderdate").cast("date").alias("day"))


def q_subscriptions_on_days(m: Models) -> DataFrame:
    """Active subscriptions and their monthly revenue on every day of a list."""
    return interval_totals(
        _asked_days(m), m.stg("raw_subscriptions"), "day", "start_date", "end_date",
        active_subs=F.lit(1).cast("long"), mrr=F.col("mrr"),
    )


def q_interval_join(m: Models) -> DataFrame:
    """Which subscriptions ran on each of the first days of a month in a list."""
    days = _asked_days(m).filter(F.dayofmonth("day") == 1).distinct()
    subscriptions = m.stg("raw_subscriptions").select("subscription_id", "start_date", "end_date")
    return interval_join(days, subscriptions, "day", "start_date", "end_date").select("day", "subscription_id")


# Faults planted into clean tables, so that a check has something to find and to pass over.
NUMBER = "try_cast(substr(transaction_ref, 2) AS bigint)"


def q_unbalanced(m: Models) -> DataFrame:
    """The ledger with some invoices' debits off by one, and others' off by a cent, which is tolerated."""
    fault = F.expr(
        f"CASE WHEN transaction_type = 'INVOICE' AND entry_id LIKE '%-1' AND {NUMBER} % 89 = 0 THEN 1.00 "
        f"WHEN transaction_type = 'INVOICE' AND entry_id LIKE '%-1' AND {NUMBER} % 97 = 0 THEN 0.01 ELSE 0.00 END"
    )
    journal = m.journal
    return posting.gl_unbalanced_refs(journal.withColumn("debit_amount", F.col("debit_amount") + fault))


def q_dq_gl_balance(m: Models) -> DataFrame:
    """The ledger without the credits of some payments."""
    lost = F.expr(f"transaction_type = 'PAYMENT' AND entry_id LIKE '%-2' AND {NUMBER} % 83 = 0")
    return quality.dq_gl_balance(m.journal.filter(~lost))


# Rows that come twice, by model.
REPEATED = {
    "stg_customers": "cast(substr(customer_id, 2) AS bigint) % 30 = 0",
    "stg_invoices": "cast(substr(invoice_id, 2) AS bigint) % 50 = 0",
    "fact_payments": "cast(substr(payment_id, 2) AS bigint) % 70 = 0",
    "dim_vendors": "cast(substr(vendor_id, 2) AS bigint) % 9 = 0",
    "fact_journal_entries": "account_code = '2100'",
}
# Parents that are missing.
MISSING = {
    "stg_customers": "cast(substr(customer_id, 2) AS bigint) % 40 = 0",
    "stg_products": "cast(substr(product_id, 2) AS bigint) % 25 = 0",
    "stg_chart_of_accounts": "account_code = '6400'",
}


def q_dq_unique(m: Models) -> DataFrame:
    """Every model that has a rule; others are not built."""
    named = m.by_name()
    models = {name: named[name] for name in quality.UNIQUE}
    for name, twice in REPEATED.items():
        copies = F.when(F.expr(twice), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        models[name] = models[name].withColumn("_copy", F.explode(copies)).drop("_copy")
    return quality.check_unique(models)


def q_dq_not_null(m: Models) -> DataFrame:
    """Counted while the models were stored, from which nothing is read, or by a scan of one that is a projection."""
    return quality.watched_not_null(m.spark, m.watched(list(quality.NOT_NULL)))


def q_dq_orphans(m: Models) -> DataFrame:
    tables = dict(m.staged())
    for name, gone in MISSING.items():
        tables[name] = tables[name].filter(f"NOT ({gone})")
    return quality.check_orphans(tables)


def q_dq_accepted_values(m: Models) -> DataFrame:
    """Declared rules, plus bill statuses against a list that lacks OPEN."""
    declared = quality.watched_accepted_values(m.by_name(), m.watched(list(dict.fromkeys(model for model, _ in quality.ACCEPTED))))
    short = quality.dq_accepted_values(m.fact_vendor_bills, "fact_vendor_bills (short list)", "status", ["PAID"])
    return short if declared is None else declared.unionByName(short)


# Not a given table but fixed rows: the chart of accounts takes part in queries and is none itself.
INLINE = ("raw_chart_of_accounts",)

QUERIES: dict[str, Callable[[Models], DataFrame]] = {
    "read_raw_csv": q_read_raw_csv,
    "read_raw_csv_inferred": q_read_raw_csv_inferred,
    "read_csv_dir": q_read_csv_dir,
    "load_csv_dir": q_load_csv_dir,
    "raw_schemas": q_raw_schemas,
    "source": q_source,
    "ref": q_ref,
    "write_csv": q_write_csv,
    "load_replace": q_load_replace,
    "load_replace_simple": q_load_replace_simple,
    "materialize_table": q_materialize_table,
    "materialize_incremental": q_materialize_incremental,
    "load_counts": lambda m: sinks.load_counts({t: m.stg(t) for t in RAW_TABLES}),
    "run_query": lambda m: serving.records(m.fact_subscriptions),
    **{bronze_name(t): (lambda m, t=t: m.stg(t)) for t in RAW_TABLES if t not in INLINE},
    "upsert": q_upsert,
    "upsert_table": q_upsert_table,
    "upsert_table_as_of": q_upsert_table_as_of,
    "dedupe_latest": q_dedupe_latest,
    "stream_upsert": q_stream_upsert,
    "stream_dedupe": q_stream_dedupe,
    "stream_late": q_stream_late,
    **{n: (lambda m, n=n: getattr(m, n)) for n in MODEL_NAMES if n != "dim_accounts"},
    **{n: (lambda m, n=n, src=src: getattr(serving, n)(getattr(m, src))) for n, src in SERVING.items()},
    "post_invoices_gl": lambda m: posting.post_invoices_gl(m.stg("raw_invoices")),
    "post_payments_gl": lambda m: posting.post_payments_gl(m.stg("raw_payments")),
    "post_vendor_bills_gl": lambda m: posting.post_vendor_bills_gl(
        m.stg("raw_vendor_bills"), m.stg("raw_chart_of_accounts")
    ),
    "post_bill_payments_gl": lambda m: posting.post_bill_payments_gl(m.stg("raw_vendor_bills")),
    "post_payroll_gl": lambda m: posting.post_payroll_gl(m.stg("raw_payroll")),
    "post_payroll_gl_by_dept": lambda m: posting.post_payroll_gl_by_dept(m.stg("raw_payroll")),
    "build_journal": lambda m: m.raw.raw_journal_entries,
    "gl_unbalanced_refs": q_unbalanced,
    "billing_schedule": lambda m: schedules.billing_schedule(m.stg("raw_subscriptions"), PERIOD_START, PERIOD_END),
    "select_paid_for_payment": lambda m: posting.select_paid_for_payment(m.stg("raw_invoices")),
    "invoice_lines_from_schedule": lambda m: schedules.invoice_lines_from_schedule(
        schedules.billing_schedule(m.stg("raw_subscriptions"), PERIOD_START, PERIOD_END)
    ),
    "one_off_invoices": q_one_off_invoices,
    "close_out_subscriptions": q_close_out_subscriptions,
    "payroll_schedule": _payroll_schedule,
    "december_bonus": q_december_bonus,
    "account_code_lookup": q_account_code_lookup,
    "revenue_by_year_type": q_revenue_by_year_type,
    "payroll_by_year": lambda m: annual.payroll_by_year(m.stg("raw_payroll")),
    "vendor_spend_by_year": lambda m: annual.vendor_spend_by_year(m.stg("raw_vendor_bills")),
    "active_subs_at_year_end": lambda m: annual.active_subs_at_year_end(
        m.stg("raw_subscriptions"), FIRST_YEAR, LAST_YEAR
    ),
    "cogs_by_year": lambda m: annual.cogs_by_year(m.stg("raw_journal_entries")),
    "annual_summary": q_annual_summary,
    "fact_invoices_bucketed": q_fact_invoices_bucketed,
    "subscriptions_on_days": q_subscriptions_on_days,
    "interval_join": q_interval_join,
    "mrr_trend_bitmaps": lambda m: serving.mrr_trend_rolled(m.revenue_bitmaps),
    "revenue_by_segment_bitmaps": lambda m: serving.revenue_by_segment_rolled(m.revenue_bitmaps),
    "revenue_by_rep_bitmaps": lambda m: serving.revenue_by_rep_rolled(m.revenue_bitmaps),
    "payroll_bitmaps": lambda m: serving.payroll_rolled(m.payroll_bitmaps),
    "payroll_annual_bitmaps": lambda m: serving.payroll_annual_rolled(m.payroll_bitmaps),
    "churn_summary": lambda m: annual.churn_summary(m.stg("raw_subscriptions")),
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_gl_balance": q_dq_gl_balance,
    "dq_orphans": q_dq_orphans,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registered query, with money as DOUBLE.

    The first query of a session that needs a model starts the jobs that store it while
    its plan is built; the streams, loads and running totals start jobs of their own too.
    """
    return as_doubles(QUERIES[name](Models(spark, sf_dir)))
