"""Writers: full replacement, CSV, row counts."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.frames import union_all
from ledgermill.session import discard

MAX_RECORDS_PER_FILE = 5_000_000
CSV_RECORDS_PER_FILE = 1_000_000


def _quoted(table: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in table.split("."))


def _version_name(table: str, number: int) -> str:
    return f"{table}__v{number}"


def table_versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the loads of a table that the catalog still holds, whole or not."""
    *schema, name = table.split(".")
    pattern = re.compile(re.escape(name.lower()) + r"__v(\d+)$")
    found = spark.catalog.listTables(*schema) if schema else spark.catalog.listTables()
    return sorted(int(m.group(1)) for t in found if not t.isTemporary and (m := pattern.fullmatch(t.name.lower())))


def current_version(spark: SparkSession, table: str) -> int | None:
    """The load that readers of ``table`` see; None where there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    extended = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").collect()}
    match = re.search(r"__v(\d+)`?\s*$", extended.get("View Text", ""))
    return int(match.group(1)) if match else None


def load_replace(
    df: DataFrame, table: str, partition_by: str | None = None, path: str | None = None, keep: int = 2,
    bucket_by: list[str] | None = None, buckets: int | None = None,
) -> int:
    """Replace what ``table`` shows with ``df`` in one step; all tasks write in parallel. Returns the load's number.

    Every load is a stored table of its own, ``<table>__v<number>``, and ``table`` is a
    view of the newest whole one. The view is changed when all rows are written, so a
    reader sees the old rows or the new ones and a load that fails changes nothing. The
    newest ``keep`` loads stay, for readers that began before and for ``read_version``;
    with ``path`` their files lie below it, a folder a load.

    ``partition_by`` (a year column, say) lays the table out for pruning; the rebalance
    then keeps a year in few files while adaptive execution splits a hot one. ``bucket_by``
    lays it out in sorted buckets, so that joins and groupings by those columns need no
    exchange. Without either rows are written where they are, with no exchange.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and current_version(spark, table) is None:  # a plain table of before
        spark.sql(f"ALTER TABLE {_quoted(table)} RENAME TO {_quoted(_version_name(table, 0))}")
    number = max(table_versions(spark, table), default=0) + 1
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    elif bucket_by:  # one file a bucket: rows move by the hash that buckets go by
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE if not bucket_by else 0)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        writer = writer.option("path", f"{path.rstrip('/')}/{uuid.uuid4().hex}")
    writer.saveAsTable(_version_name(table, number))
    show_version(spark, table, number)
    drop_versions(spark, table, keep)
    return number


def show_version(spark: SparkSession, table: str, number: int) -> None:
    """Let ``table`` show one of its loads: the newest, or an earlier one to go back to."""
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(table)} AS SELECT * FROM {_quoted(_version_name(table, number))}")


def read_version(spark: SparkSession, table: str, number: int) -> DataFrame:
    """The rows of one load, whichever ``table`` shows now."""
    return spark.table(_version_name(table, number))


def drop_versions(spark: SparkSession, table: str, keep: int = 2) -> list[int]:
    """Drop loads, and their files, but the one that is shown and the newest ones before it, ``keep`` in all.

    Loads after the one shown stay: a writer may be about to show them.
    """
    shown = current_version(spark, table)
    gone = [n for n in table_versions(spark, table) if shown is not None and n < shown][: -(keep - 1) or None]
    for number in gone:
        held = _version_name(table, number)
        place = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(held)}").collect()}.get("Location")
        spark.sql(f"DROP TABLE {_quoted(held)}")
        if place:
            discard(spark, place)
    return gone


def load_replace_simple(df: DataFrame, path: str) -> None:
    """Replace the parquet data set at ``path``."""
    df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Headered CSV with yyyy-MM-dd dates, empty for NULL, blanks in text kept.

    Fields that hold a comma, a quote or a line break stand in quotes, with quotes inside
    doubled, as database loaders and data-frame readers expect; backslashes are plain
    text. NULL is an empty field, an empty text one in quotes. ``compression`` names a
    codec that readers tell by the file name; such a file is read by one task, so every
    task's rows are cut into files of at most ``CSV_RECORDS_PER_FILE``.
    """
    packed = {"compression": compression, "maxRecordsPerFile": CSV_RECORDS_PER_FILE} if compression else {}
    (
        df.write.mode("overwrite")
        .options(**packed)
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampFormat", "yyyy-MM-dd")
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return union_all(parts)
