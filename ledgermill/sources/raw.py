"""Readers of the raw CSV tables and lookup of stored tables by name."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.columns import quoted
from ledgermill.schemas import OPTIONAL, RAW_TABLES, raw_schema
from ledgermill.sources.sinks import load_replace

# Text that an inferring reader takes for a missing value.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


# A field in quotes doubles the quotes inside it; a backslash is plain text. Every field of
# every record is looked at, so that a record which is cut short is an error and not two rows.
QUOTING = {"header": True, "nullValue": "", "quote": '"', "escape": '"', "mode": "FAILFAST", "columnPruning": False}
EMPTY = "\ufffcempty\ufffc"  # stands for a quoted empty field while a file is read


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field of the files holds a line break: its first line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def _line_breaks(spark: SparkSession, path: str, multi_line: bool | None) -> dict[str, object]:
    """Options for files whose quoted fields may hold line breaks; None looks at the lines first.

    Such a file cannot be cut at line ends and is read by one task, so many files are
    better than a large one.
    """
    return {"multiLine": has_line_breaks(spark, path) if multi_line is None else multi_line}


def read_raw_csv(spark: SparkSession, path: str, table: str, multi_line: bool | None = False) -> DataFrame:
    """One raw table with its declared schema; an empty field is NULL, one in quotes an empty text, ``N/A`` stays text.

    Columns are bound by the names in the header, in whatever order they come. A header
    with a missing or unknown column is an error; the columns that only the revised files
    have (``OPTIONAL``) may be missing and are NULL then. Fields may stand in quotes, with
    quotes inside doubled. ``multi_line`` allows line breaks inside them (None looks for
    some first); a file that has some is an error without it. Where lines end in CR LF, a
    CR LF inside quotes is read as a line feed.
    """
    declared = raw_schema(table)
    options = {**QUOTING, **_line_breaks(spark, path, multi_line), "emptyValue": EMPTY, "dateFormat": "yyyy-MM-dd"}
    header = spark.read.options(**options).csv(path).columns
    optional = OPTIONAL.get(table, ())
    missing = [c for c in declared.names if c not in header and c not in optional]
    unknown = [c for c in header if c not in declared.names]
    if missing or unknown:
        raise ValueError(f"{path}: {table} lacks {missing} and has unknown {unknown}")
    present = T.StructType([declared[c] for c in header])
    # enforceSchema=False makes every file prove that its header is the one read above.
    df = spark.read.schema(present).options(**options, enforceSchema=False).csv(path)
    return df.select(*[_value(f) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in declared])


def _value(column: T.StructField) -> Column:
    if not isinstance(column.dataType, T.StringType):
        return F.col(column.name)
    return F.when(F.col(column.name) == EMPTY, "").otherwise(F.col(column.name)).alias(column.name)


def nullify(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Text columns with missing-value tokens replaced by NULL."""
    return df.select(
        *[
            F.when(~F.col(quoted(f.name)).isin(*tokens), F.col(quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def read_raw_csv_inferred(
    spark: SparkSession, path: str, extra_null_tokens: tuple[str, ...] = NULL_TOKENS, multi_line: bool | None = None
) -> DataFrame:
    """A headered CSV with inferred types; missing-value tokens, quoted or not, become NULL.

    Quotes as in ``read_raw_csv``. Inference reads the files once more, and so does
    looking for line breaks in quotes unless ``multi_line`` says whether there are any;
    declared schemas are the main path.
    """
    options = {**QUOTING, **_line_breaks(spark, path, multi_line), "emptyValue": "", "inferSchema": True}
    return nullify(spark.read.options(**options).csv(path), extra_null_tokens)


def read_csv_dir(spark: SparkSession, folder: str, skip: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Every CSV file (or folder of CSV parts) of ``folder`` by name, except those skipped.

    The listing is reduced to distinct top-level names before it reaches the driver.
    """
    folder = folder.rstrip("/")
    base = re.escape(folder.rsplit("/", 1)[-1])
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(folder)
        .select(F.regexp_extract("path", f"/{base}/([^/]+)", 1).alias("entry"))
        .distinct()
    )
    entries = {row["entry"].removesuffix(".csv"): row["entry"] for row in listing.collect()}
    return {
        name: read_raw_csv_inferred(spark, f"{folder}/{entry}")
        for name, entry in sorted(entries.items())
        if name not in skip
    }


def load_csv_dir(
    spark: SparkSession, folder: str, schema: str, root: str, skip: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """Replace one stored table ``schema.<name>`` for every CSV of ``folder``; returns the stored tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    names = []
    for name, df in read_csv_dir(spark, folder, skip).items():
        load_replace(df, f"{schema}.{name}", path=f"{root.rstrip('/')}/{name}")
        names.append(name)
    return {name: source(spark, schema, name) for name in names}


def read_raw_dir(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All declared raw tables found as ``<folder>/<table>.csv``."""
    return {table: read_raw_csv(spark, f"{folder.rstrip('/')}/{table}.csv", table) for table in RAW_TABLES}


def source(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """A stored raw table by schema and name."""
    return spark.table(f"{schema}.{table}")


def ref(spark: SparkSession, model: str, schema: str | None = None) -> DataFrame:
    """A stored model by name."""
    return spark.table(f"{schema}.{model}" if schema else model)
