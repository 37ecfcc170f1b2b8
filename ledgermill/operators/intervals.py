"""Points against intervals without a loop over both: an equi-join on date buckets, and sums over a tree of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, LEVEL, NODE = "_bucket", "_level", "_node"


def _days(points: DataFrame, point: str) -> tuple[int, int] | None:
    """First and last day that is asked for; one small job."""
    found = points.agg(F.min(F.unix_date(point)).alias("a"), F.max(F.unix_date(point)).alias("b")).first()
    return None if found["a"] is None else (found["a"], found["b"])


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, width: int = 32) -> DataFrame:
    """All pairs of a point and an interval with start <= point < end; an open end lasts.

    Every interval stands in the buckets of ``width`` days that it touches, cut to the
    days asked for, and meets the points of each by an equi-join, which adaptive
    execution can split where a bucket is hot; the ends are verified on the pairs. Wider
    buckets copy long intervals less often and compare more pairs. Points without a date
    and intervals without a start match nothing. Repeated points and intervals pair each
    time. Column names of both must differ.
    """
    days = _days(points, point)
    if days is None:
        return points.join(intervals, F.lit(False))
    first, last = days
    begins, ends = F.unix_date(start), F.coalesce(F.unix_date(end) - 1, F.lit(last))
    low, high = F.greatest(begins, F.lit(first)), F.least(ends, F.lit(last))
    spread = intervals.filter(begins.isNotNull() & (low <= high)).withColumn(
        BUCKET, F.explode(F.sequence(F.floor(low / width), F.floor(high / width)))
    )
    asked = points.withColumn(BUCKET, F.floor(F.unix_date(point) / width))
    inside = (F.col(start) <= F.col(point)) & (F.col(end).isNull() | (F.col(point) < F.col(end)))
    return asked.join(spread, BUCKET).filter(inside).drop(BUCKET)


def interval_totals(
    points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, **measures: Column
) -> DataFrame:
    """(point, measures) for every distinct point: sums over the intervals with start <= point < end, 0 where there are none.

    No pair of a point and an interval is made. The days asked for are the leaves of a
    binary tree. An interval is the union of at most two nodes a level, and its measures
    are summed there, before the shuffle; a point's total is the sum over the one node a
    level that holds it. So the work is intervals times levels, the tree has fewer than
    twice as many nodes as days, and a day on which all intervals run costs no more than
    another.
    """
    asked = points.select(point).filter(F.col(point).isNotNull()).distinct()
    days = _days(asked, point)
    if days is None:
        return asked.select(point, *[F.lit(0).cast("long").alias(m) for m in measures])
    first, last = days
    levels = range(max(1, (last - first + 1).bit_length()) + 1)
    low = F.greatest(F.unix_date(start) - first, F.lit(0)).cast("long")
    high = F.least(F.coalesce(F.unix_date(end) - first, F.lit(last - first + 1)), F.lit(last - first + 1)).cast("long")
    nodes = []
    for k in levels:
        a, b = F.ceil(F.col("_low") / F.lit(1 << k)), F.floor(F.col("_high") / F.lit(1 << k))
        nodes.append(F.when((a < b) & (a % 2 == 1), F.struct(F.lit(k).alias(LEVEL), a.alias(NODE))))
        nodes.append(F.when((a < b) & (b % 2 == 1), F.struct(F.lit(k).alias(LEVEL), (b - 1).alias(NODE))))
    covered = (
        intervals.filter(F.col(start).isNotNull())
        .select(low.alias("_low"), high.alias("_high"), *[v.alias(m) for m, v in measures.items()])
        .filter("_low < _high")
        .withColumn("_nodes", F.filter(F.array(*nodes), lambda x: x.isNotNull()))
        .select(F.explode("_nodes").alias("_at"), *measures)
        .groupBy(F.col(f"_at.{LEVEL}").alias(LEVEL), F.col(f"_at.{NODE}").alias(NODE))
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    place = (F.unix_date(point) - first).cast("long")
    up = F.array(*[F.struct(F.lit(k).alias(LEVEL), F.shiftright(place, k).alias(NODE)) for k in levels])
    held = asked.select(point, F.inline(up)).join(covered, [LEVEL, NODE], "left")
    return held.groupBy(point).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
