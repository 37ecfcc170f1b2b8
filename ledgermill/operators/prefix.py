"""Running totals and dense numbers over all rows, by ranges: no task sees more than one range of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.session import scratch_path

RANGE, BEFORE = "_range", "_before"


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows dealt into ranges of ``order`` and written once, with the range.

    Equal rows by ``order`` share a range. Written, because ranges are cut by a sample of
    the rows and would be cut elsewhere when they are computed again.
    """
    path = scratch_path(df.sparkSession, "ranges")
    placed = df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id())
    placed.write.parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def before_ranges(totals: DataFrame, total: str) -> DataFrame:
    """(RANGE, BEFORE): the sum of ``total`` over all earlier ranges, from one row a range."""
    held = totals.schema[total].dataType
    kind = f"decimal(38,{held.scale})" if isinstance(held, T.DecimalType) else held.simpleString()
    packed = totals.agg(F.sort_array(F.collect_list(F.struct(RANGE, F.coalesce(F.col(total).cast(kind), F.lit(0).cast(kind)).alias("n")))).alias("all"))
    earlier = F.expr(
        f"transform(all, (x, i) -> struct(x.{RANGE} AS {RANGE}, "
        f"aggregate(slice(all, 1, i), cast(0 AS {kind}), (a, y) -> cast(a + y.n AS {kind})) AS {BEFORE}))"
    )
    return packed.select(F.inline(earlier))


def running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to each by ``order``, which must be total.

    Two levels: rows are dealt into ranges, each range is summed up by itself, and what
    all ranges before it hold is added. NULLs count as nothing.
    """
    ranged = in_ranges(df, order)
    totals = ranged.groupBy(RANGE).agg(F.sum(value).alias("_total"))
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row a range: far below any threshold, whatever the number of rows.
    joined = ranged.withColumn("_inside", F.sum(value).over(inside)).join(before_ranges(totals, "_total"), RANGE)
    total = F.coalesce(F.col("_inside"), F.lit(0)) + F.col(BEFORE)
    return joined.select(*df.columns, total.alias(name))


def dense_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): the distinct values of ``column``, numbered from 0 without gaps in their order; NULL has no number."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ranged = in_ranges(values, [F.col(column)])
    totals = ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_total"))
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(column)) - 1
    numbered = ranged.withColumn("_place", place).join(before_ranges(totals, "_total"), RANGE)
    return numbered.select(column, (F.col(BEFORE) + F.col("_place")).alias(name))
