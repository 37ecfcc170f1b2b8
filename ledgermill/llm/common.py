"""What the operators share: stored intermediates, words, row keys and connected components."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import scratch_path

# Words are runs of anything but ASCII white space; bytes.split() cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called that (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder all executors share and read it back.

    The rows are computed once; a lost executor can only cost a re-read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete folders made by ``store`` that no result reads any more."""
    for df in stored:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsc.hadoopConfiguration()
        for folder in {re.sub(r"/[^/]+$", "", f) for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def learnable(doc_id: str | Column, parts: int, held_out: int) -> Column:
    """True for the rows a model may learn from: crc32 of the id as text, by its remainder."""
    key = col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(held_out)) != held_out


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text, empty for null."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``limit`` text bytes (or one longer text), so memory stays bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(start, end - start)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b); a root is its component's smallest node.

    Alternates large-star and small-star steps, each a map-side combined minimum per
    node joined back to the edges, until every edge points at a root. Rounds grow with
    the logarithm of the longest chain; each is stored, so lineage stays short.
    """
    state = store(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges"
    )
    while True:
        parents = state.groupBy("u").agg(F.count("*").alias("n"))
        inner = state.join(parents.select(F.col("u").alias("v"), "n"), "v", "left")
        if inner.filter("n IS NOT NULL").isEmpty() and parents.filter("n > 1").isEmpty():
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                state.select(F.col("v"), F.col("v")).distinct()
            )
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u > v")
            .distinct()
        )
        before, state = state, store(small, "edges")
        discard(before)
