"""Sharding by a Feistel permutation over global row numbers, with cycle walking.

DataFrame operations only. The permutation is a function of the number of rows and a
seed, so any row's shard and slot can be computed, and the row at a slot found, without data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import col, free_name, store

LOCAL_BITS = 33  # of monotonically_increasing_id: the row's place in its partition
ROUNDS = 6


@dataclass
class Permutation:
    """A permutation of 0 .. rows - 1: a Feistel network over ``left`` x ``right`` >= rows pairs.

    Values that leave the range are sent through the network again until they are inside.
    There are fewer than ``left`` pairs outside, about the square root of ``rows``; the
    longest chain of them that a value from inside enters, ``walks``, is measured, so no
    row needs more steps than are taken. (Chains that nothing enters may be loops.)
    """

    rows: int
    seed: int
    left: int
    right: int
    walks: int

    @classmethod
    def over(cls, spark: SparkSession, rows: int, seed: int) -> Permutation:
        left = max(1, math.isqrt(max(0, rows - 1)) + 1)
        right = max(1, -(-rows // left))
        shape = cls(rows, seed, left, right, 0)
        outside = spark.range(rows, left * right).withColumn("x", F.col("id"))
        entered = shape.network(outside, "x", True).filter(F.col("x") < rows)
        outside = entered.select(F.col("id").alias("x"))
        while not outside.isEmpty():
            outside = store(shape.network(outside, "x", False).filter(F.col("x") >= rows), "outside")
            shape.walks += 1
        return shape

    def network(self, df: DataFrame, x: str, inverse: bool, only: Column | None = None) -> DataFrame:
        """Replace ``x`` by its image; rows for which ``only`` is false keep theirs."""
        l, r, old = (free_name(df, n) for n in ("feistel_left", "feistel_right", "feistel_old"))
        df = df.withColumn(old, F.col(x)).withColumns(
            {l: F.expr(f"`{x}` div {self.right}"), r: F.col(x) % F.lit(self.right)}
        )
        sign = -1 if inverse else 1
        for k in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            half, other, size = (l, r, self.left) if k % 2 == 0 else (r, l, self.right)
            mixed = F.pmod(F.xxhash64(F.col(other), F.lit(self.seed), F.lit(k)), F.lit(size))
            df = df.withColumn(half, F.pmod(F.col(half) + sign * mixed, F.lit(size)))
        image = F.col(l) * self.right + F.col(r)
        return df.withColumn(x, image if only is None else F.when(only, image).otherwise(F.col(old))).drop(l, r, old)

    def apply(self, df: DataFrame, x: str, inverse: bool = False) -> DataFrame:
        """``df`` with the row numbers in ``x`` permuted."""
        df = self.network(df, x, inverse)
        for _ in range(self.walks):
            df = self.network(df, x, inverse, F.col(x) >= self.rows)
        return df


def number_rows(docs: DataFrame, order: list[Column], out: str) -> tuple[DataFrame, int]:
    """``docs`` with ``out``, its place (from 0) in the whole table's ``order``, and the number of rows.

    One range exchange: rows are sorted inside ranges, stored with their place there, and
    the counts of the ranges (one row each) give what to add.
    """
    place, part = free_name(docs, "row_place"), free_name(docs, "row_part")
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = store(ranged.withColumn(place, F.monotonically_increasing_id()), "ranges")
    in_part = F.shiftright(F.col(place), LOCAL_BITS)
    counts = {r[0]: r[1] for r in ranged.groupBy(in_part).count().collect()}
    offsets, total = [], 0
    for p in sorted(counts):
        offsets.append((p, total))
        total += counts[p]
    spark = docs.sparkSession
    start = free_name(docs, "row_start")
    starts = spark.createDataFrame(offsets or [(0, 0)], f"{part} long, {start} long")
    local = F.col(place).bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    # One row for each range, of which there are as many as shuffle partitions.
    numbered = ranged.join(F.broadcast(starts), in_part == F.col(part)).withColumn(out, F.col(start) + local)
    return numbered.drop(place, part, start), total


def shard_rows(docs: DataFrame, *, key: str = "doc_id", shards: int = 8, seed: int = 11) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long) to every row: a reproducible shuffle over all rows.

    Rows are numbered by key, then by a digest of all columns; null keys come first. Row n
    goes to place p of the permutation, shard p modulo ``shards``, slot p divided by it: the
    counts of shards differ by one at most, and slots have no gaps. Wholly equal rows are
    interchangeable. Null, empty or very long texts are rows like others, an empty table gives none.
    Columns that have the result names already are replaced.
    """
    docs = docs.drop("shard", "slot")
    at = free_name(docs, "row_number")
    order = [col(key).asc_nulls_first(), F.xxhash64(*[col(c) for c in docs.columns])]
    numbered, rows = number_rows(docs, order, at)
    placed = Permutation.over(docs.sparkSession, rows, seed).apply(numbered, at)
    return placed.select(
        *[col(c) for c in docs.columns],
        (F.col(at) % shards).cast("int").alias("shard"),
        F.expr(f"`{at}` div {shards}").alias("slot"),
    )
