"""Keyed bronze loads: project, stamp, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.schemas import bronze_columns


def stage(raw: DataFrame, table: str, load_ts: str | None = None) -> DataFrame:
    """Declared columns of one raw table, plus the load timestamp when given."""
    columns = bronze_columns(table)
    staged = raw if columns is None else raw.select(*columns)
    if load_ts is None:
        return staged
    return staged.withColumn("ingestion_timestamp", F.lit(load_ts).cast("timestamp"))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``batch``, followed by all of ``batch``.

    Keys gone from the source survive, duplicates inside the batch stay, and a
    NULL key never matches. The batch side is reduced to distinct keys before it
    is shuffled; a hot target key is split by the adaptive skew join.
    """
    return target.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch)


def dedupe_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key by ``order``, remaining columns breaking ties.

    A max over a struct rather than a ranking window: every task first sorts its own
    rows and reduces them to one per key (a struct has no hash aggregate), so of a key
    repeated in a third of the rows only one row per task is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = order + [c for c in rest if c not in order]
    newest = F.max(F.struct(*ranked)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*[c if c in keys else F.col(f"_newest.`{c}`").alias(c) for c in df.columns])


def newest(current: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key of both by ``order``; rows with a NULL in the key are all kept."""
    both = current.unionByName(batch)
    partial = F.lit(False)
    for k in keys:
        partial = partial | F.col(k).isNull()
    return dedupe_latest(both.filter(~partial), keys, order).unionByName(both.filter(partial))
