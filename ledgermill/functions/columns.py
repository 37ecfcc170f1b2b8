"""Cleaning, date, money and variance expressions.

Money stays DECIMAL through every sum and window so results do not depend on
the order rows arrive in; ``as_doubles`` is applied once, at the output edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDE_MONEY = "decimal(24,2)"


def clean_upper(col: str | Column) -> Column:
    """Trim blanks and upper-case."""
    return F.upper(F.trim(col))


def status_is(col: str | Column, value: str) -> Column:
    """True when the cleaned status equals ``value``; a NULL status is False."""
    return F.coalesce(clean_upper(col) == value, F.lit(False))


def month_of(col: str | Column) -> Column:
    return F.trunc(col, "month")


def quarter_of(col: str | Column) -> Column:
    return F.trunc(col, "quarter")


def rounded_int(col: str | Column) -> Column:
    """Integer cast that rounds half away from zero instead of truncating."""
    return F.round(col).cast("int")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100`` rounded; NULL when ``whole`` is zero or NULL."""
    whole = whole.cast(WIDE_MONEY)
    return F.round(part.cast(WIDE_MONEY) / F.nullif(whole, F.lit(0).cast(WIDE_MONEY)) * 100, digits)


def change_percent(value: Column, prior: Column) -> Column:
    """Percentage change against the size of ``prior``."""
    return percent(value - prior, F.abs(prior))


def by_month(*partition: str, extra: tuple[str, ...] = ()) -> WindowSpec:
    """Month-ordered window whose NULL month sorts last."""
    order = [F.col(c).asc_nulls_last() for c in ("entry_month", *extra)]
    return Window.partitionBy(*partition).orderBy(*order)


def running(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def prior(col: str, rows: int, spec: WindowSpec) -> Column:
    """Value ``rows`` rows earlier, 0 where there is none."""
    return F.lag(col, rows, 0).over(spec)


def with_variance(df: DataFrame, value: str, spec: WindowSpec, rows: int, prior_as: str, abs_as: str, pct_as: str) -> DataFrame:
    """Add the prior value, the change and the percentage change over ``spec``."""
    return (
        df.withColumn(prior_as, prior(value, rows, spec))
        .withColumn(abs_as, F.col(value) - F.col(prior_as))
        .withColumn(pct_as, change_percent(F.col(value), F.col(prior_as)))
    )


def row_key(month: str, name: str | Column) -> Column:
    """md5 of ``month|name``; NULL when either is NULL."""
    name = F.col(name) if isinstance(name, str) else name
    return F.md5(F.concat(F.date_format(month, "yyyy-MM-dd"), F.lit("|"), name))


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, as ``F.col`` takes it."""
    return "`" + name.replace("`", "``") + "`"


def as_doubles(df: DataFrame) -> DataFrame:
    """Output edge: every DECIMAL column becomes DOUBLE."""
    return df.select(
        *[
            F.col(quoted(f.name)).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def with_audit(df: DataFrame, loaded_at: str, column: str, **constants: str) -> DataFrame:
    """Add the load timestamp (and, for reports, a run id) kept in stored tables."""
    extra = [F.lit(v).alias(k) for k, v in constants.items()]
    return df.select("*", F.lit(loaded_at).cast("timestamp").alias(column), *extra)
