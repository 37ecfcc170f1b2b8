"""Helpers over whole DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(parts: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns.

    Halves are united first: a left-deep chain would make the analyzer walk the
    growing plan once per part.
    """
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return union_all(parts[:middle]).unionByName(union_all(parts[middle:]))
