"""Exact length histogram of encoded documents, and what every context limit would keep of them."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import col, slices

BLOCK = 4096  # lengths whose sums are added up together


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """A byte-pair encoding from a rank file, loaded once in a worker. Special tokens are ordinary text."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def lengths(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(length, documents): how many documents have each encoded length, as each task counted them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path, pattern).encode_ordinary
        for batch in slices(batches, text, 1 << 24):
            sizes = np.array([len(encode(t)) if t else 0 for t in batch.column(text).to_pylist()], np.int64)
            length, documents = np.unique(sizes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(documents)], ["length", "documents"])

    return docs.select(col(text).alias(text)).mapInArrow(count, "length long, documents long")


def histogram(partial: DataFrame) -> DataFrame:
    """(length, documents) summed over tasks."""
    return partial.groupBy("length").agg(F.sum("documents").alias("documents"))


def limits(counts: DataFrame) -> DataFrame:
    """What a context limit equal to each length keeps, from suffix sums of the histogram.

    Columns: context_limit, documents (of exactly that length), documents_longer,
    tokens_longer (their tokens), documents_within, tokens_within, truncated_tokens (all
    documents cut at the limit), lost_tokens and quantile (share of documents within).
    Any limit between two lengths follows from the row of the smaller one. Sums run over
    blocks of lengths first and inside each block then, so no task sees all lengths.
    """
    block = F.floor(F.col("length") / BLOCK)
    rows = counts.withColumns({"block": block, "tokens": F.col("length") * F.col("documents")})
    per_block = rows.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    per_block = per_block.select(
        F.col("block").alias("b"),
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(every).alias("all_documents"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    longer = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {"d_in": F.coalesce(F.sum("documents").over(longer), F.lit(0)), "t_in": F.coalesce(F.sum("tokens").over(longer), F.lit(0))}
    ).join(per_block, F.col("block") == F.col("b"))
    more, tokens = F.col("d_in") + F.col("d_above"), F.col("t_in") + F.col("t_above")
    within = F.col("all_tokens") - tokens
    return rows.select(
        F.col("length").alias("context_limit"),
        "documents",
        more.alias("documents_longer"),
        tokens.alias("tokens_longer"),
        (F.col("all_documents") - more).alias("documents_within"),
        within.alias("tokens_within"),
        (within + F.col("length") * more).alias("truncated_tokens"),
        (tokens - F.col("length") * more).alias("lost_tokens"),
        ((F.col("all_documents") - more) / F.col("all_documents")).alias("quantile"),
    )


def token_counts(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``limits`` of the encoded lengths of ``docs``.

    Null and empty texts have length 0, a text of any length is encoded as a whole.
    Repeated rows count each time. An empty table gives no rows. Other columns are not read.
    """
    return limits(histogram(lengths(docs, path, pattern, text)))
