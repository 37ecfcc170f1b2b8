"""SimHash near-duplicates: 64-bit fingerprints linked by a grid join over segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import col, connected_components, free_name, slices, store, text_bytes

SEGMENTS = 32  # segments of two bits; the embedding has one bit count, 0 to 2, for each
LOW_BITS = 0x5555555555555555  # the low bit of every segment
SLAB = 1 << 14  # shingle hashes added up at once
CELL = 4096  # fingerprints of one grid cell compared at once


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles of the lower-cased text."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, 42) for g in grams], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLAB):
        bits = np.unpackbits(hashes[at : at + SLAB].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """Add ``fingerprint`` (bigint holding the 64 bits) to every row."""
    docs = docs.drop("fingerprint")
    names = [*docs.columns, "fingerprint"]
    schema = docs.withColumn("fingerprint", F.lit(0).cast("long")).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            marks = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column(text))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks.view(np.int64))], names)

    return docs.mapInArrow(add, schema)


def embedding(fp: Column) -> Column:
    """The 32 segment bit counts, packed two bits each: a segment with one bit is 1, one with both 2."""
    upper = F.shiftrightunsigned(fp, 1)
    one = fp.bitwiseXOR(upper).bitwiseAND(F.lit(LOW_BITS))
    both = fp.bitwiseAND(upper).bitwiseAND(F.lit(LOW_BITS))
    return one.bitwiseOR(F.shiftleft(both, 1))


def grid_masks(distance: int, spare: int) -> list[int]:
    """Masks of the subspaces in which fingerprints are put on the grid.

    The 32 counts are dealt into ``distance + spare`` groups. A Manhattan distance of at
    most ``distance`` leaves at least ``spare`` groups without any difference, so two
    such points share a cell of the subspace of some ``spare`` groups.
    """
    groups = np.array_split(np.arange(SEGMENTS), distance + spare)
    masks = [sum(3 << (2 * int(s)) for s in g) for g in groups]
    unsigned = [sum(c) for c in combinations(masks, spare)]
    return [m - (1 << 64) if m >> 63 else m for m in unsigned]


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of the segment bit counts of fingerprints; never above their bit distance."""
    low = np.uint64(LOW_BITS)
    one = np.uint64(1)

    def unary(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high = x >> one
        return (x | high) & low, x & high & low  # at least one bit set, both bits set

    (a1, a2), (b1, b2) = unary(a), unary(b)
    return np.bitwise_count(a1 ^ b1) + np.bitwise_count(a2 ^ b2)


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs are within the bit distance: the lower bound first, the bits themselves for what it leaves."""
    ok = manhattan(a, b) <= distance
    left = np.nonzero(ok)
    a, b = np.broadcast_arrays(a, b)
    ok[left] = np.bitwise_count(a[left] ^ b[left]) <= distance
    return ok


def forest(group: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """(root, member) edges that connect what is linked inside one group of distinct fingerprints."""
    out, open_ = [], np.arange(len(group))
    while len(open_):
        root, open_ = open_[0], open_[1:]
        front = np.array([root])
        while len(front) and len(open_):
            hit = np.zeros(len(open_), bool)
            for at in range(0, len(front), 256):
                hit |= near(group[front[at : at + 256], None], group[None, open_], distance).any(axis=0)
            front, open_ = open_[hit], open_[~hit]
            out += [(int(group[root]), int(group[m])) for m in front]
    return out


def link_cells(keys: list[str], distance: int, limit: int | None):
    """Function for mapInArrow over rows sorted by ``keys``: edges inside every cell.

    Yields (a, b) edges as rows without a block. A cell with more than ``limit``
    fingerprints is passed on as numbered blocks of them instead.
    """
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = [np.empty(0, np.int64)] * width
        carry_fp = np.empty(0, np.int64)
        block = 0  # blocks of the carried cell that were passed on already

        def rows(cell, blocks, a, b):
            cell = [pa.array(c, pa.int64()) for c in cell]
            return pa.RecordBatch.from_arrays(
                [*cell, pa.array(blocks, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                [*keys, "block", "a", "b"],
            )

        def linked(edges):
            none = np.zeros(len(edges), np.int64)
            a, b = (np.array([e[i] for e in edges], np.uint64).view(np.int64) for i in (0, 1))
            return rows([none] * width, [-1] * len(edges), a, b)

        def close(cells, fps, last):
            """Cells that are complete; the last one only if ``last``. Small ones by shifted comparison."""
            nonlocal carry, carry_fp, block
            change = np.zeros(len(fps), bool)
            change[:1] = True
            for c in cells:
                change[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(change)
            ends = np.append(starts[1:], len(fps))
            done = len(starts) if last else max(0, len(starts) - 1)
            edges, sizes = [], ends - starts
            # Cells of two to eight: all are compared at once, one shift at a time.
            small = np.flatnonzero((sizes[:done] >= 2) & (sizes[:done] <= 8))
            if block and done and small.size and small[0] == 0:
                small = small[1:]
            u = fps.view(np.uint64)
            for shift in range(1, 8):
                at = [starts[small] + k for k in range(8 - shift)]
                for k, first in enumerate(at):
                    first = first[sizes[small] > k + shift]
                    if len(first):
                        a, b = u[first], u[first + shift]
                        ok = near(a, b, distance)
                        edges += zip(a[ok].tolist(), b[ok].tolist())
            passed = []
            for i in range(done):
                if i == 0 and block:
                    passed.append((i, block))
                elif sizes[i] > 8:
                    if limit and sizes[i] > limit:
                        passed.append((i, 0))
                    else:
                        edges += forest(np.unique(u[starts[i] : ends[i]]), distance)
            out = [linked(edges)] if edges else []
            for i, first in passed:
                part = slice(starts[i], ends[i])
                n = ends[i] - starts[i]
                out.append(rows([c[part] for c in cells], first + np.arange(n) // (limit or n), fps[part], fps[part]))
            if done:
                block = 0
            start = len(fps) if last else (starts[-1] if len(starts) else 0)
            carry, carry_fp = [c[start:] for c in cells], fps[start:]
            if limit and not last and len(carry_fp) > limit:  # an open cell that is too large already
                whole = len(carry_fp) // limit * limit
                out.append(rows([c[:whole] for c in carry], block + np.arange(whole) // limit, carry_fp[:whole], carry_fp[:whole]))
                block += whole // limit
                carry, carry_fp = [c[whole:] for c in carry], carry_fp[whole:]
                if not len(carry_fp):  # keep one row, so that the cell is recognised; comparing it twice does no harm
                    carry, carry_fp = [c[-1:] for c in cells], fps[-1:]
            return out

        for batch in batches:
            got = [batch.column(k).to_numpy() for k in keys]
            cells = [np.concatenate([c, g]) for c, g in zip(carry, got)]
            yield from close(cells, np.concatenate([carry_fp, batch.column("fp").to_numpy()]), False)
        yield from close(carry, carry_fp, True)

    return run


def links(distinct: DataFrame, distance: int, spare: int = 3, cell: int = CELL) -> DataFrame:
    """Edges (a, b) that connect all of ``distinct`` (column fp) within the bit distance.

    Not every near pair is listed: inside a cell only a spanning forest of them is, so a
    dense group of k fingerprints costs k edges for each subspace. Cells with more than
    ``cell`` members are compared block against block in tasks of their own.
    """
    masks = grid_masks(distance, spare)
    keys = ["space", "cell"]
    schema = "space long, cell long, block long, a long, b long"
    at = F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("space"), F.lit(m).cast("long").alias("mask")) for k, m in enumerate(masks)]))
    on_grid = (
        distinct.select("fp", embedding(F.col("fp")).alias("e"), at.alias("s"))
        .select("s.space", F.col("e").bitwiseAND(F.col("s.mask")).alias("cell"), "fp")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "fp")
    )
    found = store(on_grid.mapInArrow(link_cells(keys, distance, cell), schema), "cells")
    edges = found.filter("block < 0").select("a", "b")
    large = found.filter("block >= 0")
    if large.isEmpty():
        return edges
    blocks = large.groupBy(*keys).agg((F.max("block") + 1).alias("n"))
    pair = ["space", "cell", "i", "j"]
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("o")
    paired = (
        large.join(blocks, keys)
        .select(*keys, "block", F.col("a").alias("fp"), other)
        .select(*keys, F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "fp")
        .repartition(*pair)
        .sortWithinPartitions(*pair, "fp")
    )
    more = paired.mapInArrow(
        link_cells(pair, distance, None), "space long, cell long, i long, j long, block long, a long, b long"
    )
    return edges.unionByName(more.select("a", "b"))


def classes(marks: DataFrame, distance: int, spare: int) -> DataFrame:
    """(fingerprint, component) of every fingerprint; ``component`` is the smallest ``who`` reachable from it."""
    distinct = store(marks.groupBy("fingerprint").agg(F.min("who").alias("least")), "distinct")
    roots = connected_components(links(distinct.select(F.col("fingerprint").alias("fp")), distance, spare))
    reached = distinct.join(roots, F.col("fingerprint") == F.col("node")).select("node", "root", "least")
    smallest = reached.groupBy("root").agg(F.min("least").alias("least"))
    moved = roots.join(smallest, "root").select("node", F.col("least").alias("moved"))
    found = distinct.join(moved, F.col("fingerprint") == F.col("node"), "left")
    return found.select("fingerprint", F.coalesce("moved", "least").alias("component"))


def components(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3, spare: int = 3
) -> DataFrame:
    """(key, fingerprint, component_id) of every row of ``docs``.

    Fingerprints link at ``distance`` differing bits or fewer; ``component_id`` is the
    smallest key reachable over links, the row's own included. Equal fingerprints are one
    point, so groups of copies are never paired up. Null, empty and blank texts have
    fingerprint 0, which links like any other; texts of fewer than ``shingle`` words are
    one shingle, and all shingles of a text of any length count. Repeated rows stay, each
    with the same result. Null keys sort last: they take part in linking, and only a
    component without any other key has a null id. An empty table gives no rows.

    A cell holds the fingerprints that agree in the counts of 16 segments; by estimate the
    densest holds one in 65,536 of all distinct ones, which are compared with each other.
    Beyond some 1e9 distinct fingerprints a larger ``spare`` makes more and smaller cells.
    """
    marks = fingerprints(docs.select(col(key).alias("key"), col(text).alias("text")), "text", shingle)
    marks = store(marks.select(F.struct(F.col("key").isNull().alias("none"), "key").alias("who"), "fingerprint"), "fingerprints")
    # Stored, so that the last join stands alone and a fingerprint of very many copies can be split.
    of_all = store(classes(marks, distance, spare), "classes")
    return marks.join(of_all, "fingerprint").select(
        F.col("who.key").alias(key), "fingerprint", F.col("component.key").alias("component_id")
    )


def keep_one(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3, spare: int = 3
) -> DataFrame:
    """``docs`` with one row left of each near-duplicate component: that with the smallest key.

    Rows with the same key are told apart by a digest of their text; of rows equal in both
    the first by a digest of all columns stays, and of wholly equal rows any. Null keys
    sort last, so a component of null keys keeps one row too. An empty table gives no rows.
    """
    digest = free_name(docs, "text_digest")
    marked = docs.withColumn(digest, F.xxhash64(col(text)))
    # Fingerprints need the key, the text and its digest only; documents are read again for the chosen rows.
    slim = marked.select(col(key).alias("key"), col(text).alias("text"), F.col(digest).alias("digest"))
    marks = fingerprints(slim, "text", shingle).select(
        F.struct(F.col("key").isNull().alias("none"), "key", "digest").alias("who"), "fingerprint"
    )
    marks = store(marks, "fingerprints")
    chosen = classes(marks, distance, spare).select(F.col("component").alias("who")).distinct()
    copies = marks.groupBy("who").agg(F.count("*").alias("n"))
    chosen = store(chosen.join(copies, "who").select("who.key", "who.digest", "n"), "chosen")
    same = col(key).eqNullSafe(F.col("chosen_key")) & (F.col(digest) == F.col("chosen_digest"))

    def rows(which: str) -> DataFrame:
        picked = chosen.filter(which).select(F.col("key").alias("chosen_key"), F.col("digest").alias("chosen_digest"))
        return marked.join(picked, same, "left_semi")

    if chosen.filter("n > 1").isEmpty():
        return rows("true").select(*[col(c) for c in docs.columns])
    rank = free_name(marked, "rank")
    order = Window.partitionBy(col(key), F.col(digest)).orderBy(F.xxhash64(*[col(c) for c in docs.columns]))
    first = rows("n > 1").withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1)
    return rows("n = 1").unionByName(first.drop(rank)).select(*[col(c) for c in docs.columns])


def hex64(fp: Column) -> Column:
    """64 bits as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
