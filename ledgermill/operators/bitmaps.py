"""Exact distinct counts that can be rolled up: bitmaps over dense ids, stored at the finest grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ID, PART, BITS = "_id", "_part", "_bitmap"
WORD = 64  # values a bitmap holds: one long, which a hash aggregate updates in place


def bitmap_rollup(df: DataFrame, by: list[str], ids: DataFrame, value: str, sums: list[str]) -> DataFrame:
    """(by, PART, BITS, sums): which values each group holds, a bit a value, with the sums of its rows.

    ``ids`` has ``value`` and ID, numbers without gaps, so a group's bitmap has parts of
    64 neighbouring values of which only those that occur are stored: never more parts
    than rows, and eight bytes for one that holds a single value. A row falls in the part
    of its value (rows without one in a part of their own), so sums over parts are sums
    over rows. Bits are set on the map side before anything is shuffled, without a sort.
    """
    numbered = df.join(ids, value, "left")
    bit = F.expr(f"shiftleft(1L, cast({ID} % {WORD} AS int))")
    return numbered.groupBy(*by, F.expr(f"{ID} div {WORD}").alias(PART)).agg(
        F.coalesce(F.bit_or(bit), F.lit(0).cast("long")).alias(BITS), *[F.sum(s).alias(s) for s in sums]
    )


def roll_up(rollup: DataFrame, by: list[str], count: str, sums: list[str]) -> DataFrame:
    """(by, count, sums) of a coarser grain, from stored bitmaps alone: parts are united, then counted."""
    parts = rollup.groupBy(*by, PART).agg(F.bit_count(F.bit_or(BITS)).alias(count), *[F.sum(s).alias(s) for s in sums])
    return parts.groupBy(*by).agg(F.sum(count).cast("long").alias(count), *[F.sum(s).alias(s) for s in sums])
