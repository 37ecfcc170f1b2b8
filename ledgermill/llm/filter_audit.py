"""How filters interact: what each removes, in every order they could be applied in.

Documents are counted by part and failure mask in Spark. The masks of a part make a
decision diagram: a level a filter, two children a node (passed, failed), equal nodes
shared, and in every node the counts of all documents below it. Swapping two neighbouring
levels rewrites only those two, and one swap after another reaches every order. In each,
the path on which all filters pass tells what every step keeps and removes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import col, slices, store, text_bytes

FILTERS = "ABCDE"  # in the order of a mask's bits, the lowest first
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
CONTINUATION = bytes(range(0x80, 0xC0))
WEIGHTS = ("documents", "good", "toxic")
STEPS = "filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: bytes) -> int:
    """The bits of the filters that look at one text only: A few words, B few distinct ones, C capitals, D symbols."""
    words = text.split()
    points = len(text if text.isascii() else text.translate(None, CONTINUATION))
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * (len(text) - len(text.translate(None, UPPER))) > 10 * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


class Node:
    """A state after some filters: ``passed`` and ``failed`` are the states after the next one."""

    __slots__ = ("passed", "failed", "weight")

    def __init__(self, passed: Node | None, failed: Node | None, weight: tuple[int, ...]):
        self.passed, self.failed, self.weight = passed, failed, weight


class Diagram:
    """A count-weighted decision diagram over failure masks, whose levels can be swapped."""

    def __init__(self, filters: str, cells: dict[int, tuple[int, ...]]):
        self.order = list(filters)
        none = (0,) * len(WEIGHTS)
        ends: dict[tuple, Node] = {}
        leaves = [cells.get(mask, none) for mask in range(1 << len(filters))]
        below = [ends.setdefault(w, Node(None, None, w)) for w in leaves]
        self.levels: list[list[Node]] = []
        # From the last filter up: two states that differ in this filter only become one node.
        for level in range(len(filters) - 1, -1, -1):
            half = 1 << level
            shared: dict[tuple[int, int], Node] = {}
            below = [self.node(shared, below[m], below[m + half]) for m in range(half)]
            self.levels.insert(0, list(shared.values()))
        self.root = below[0]

    @staticmethod
    def node(shared: dict[tuple[int, int], Node], passed: Node, failed: Node) -> Node:
        key = id(passed), id(failed)
        if key not in shared:
            shared[key] = Node(passed, failed, tuple(a + b for a, b in zip(passed.weight, failed.weight)))
        return shared[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next; nodes above and below stay as they are."""
        shared: dict[tuple[int, int], Node] = {}
        for top in self.levels[level]:
            p, f = top.passed, top.failed
            top.passed = self.node(shared, p.passed, f.passed)
            top.failed = self.node(shared, p.failed, f.failed)
        self.levels[level + 1] = list(shared.values())
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def path(self) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
        """(weight kept, weight removed) of every step."""
        steps, at = [], self.root
        while at.passed is not None:
            steps.append((at.passed.weight, at.failed.weight))
            at = at.passed
        return steps


def plain_changes(n: int) -> Iterator[int]:
    """Places of the swaps that lead through all orders of n things, each once."""
    if n < 2:
        return
    inner = plain_changes(n - 1)
    while True:
        yield from range(n - 2, -1, -1)
        if (step := next(inner, None)) is None:
            return
        yield step + 1
        yield from range(n - 1)
        if (step := next(inner, None)) is None:
            return
        yield step


def audit(filters: str, cells: dict[int, tuple[int, ...]]) -> list[tuple]:
    """Rows of STEPS for every order, from the weights of a part's failure masks."""
    diagram = Diagram(filters, cells)
    steps = {"".join(diagram.order): diagram.path()}
    for level in plain_changes(len(filters)):
        diagram.swap(level)
        steps["".join(diagram.order)] = diagram.path()
    removed = {f: [path[order.index(f)][1][0] for order, path in steps.items()] for f in filters}
    # Applied first a filter removes all that fail it, applied last those that fail nothing else.
    fails = {order[0]: path[0][1][0] for order, path in steps.items()}
    unique = {order[-1]: path[-1][1][0] for order, path in steps.items()}
    rows = []
    for order, path in sorted(steps.items()):
        for k, (f, (kept, gone)) in enumerate(zip(order, path), 1):
            rows.append((order, k, kept[0], gone[0], fails[f] - gone[0], unique[f], gone[1], gone[2], sum(removed[f])))
    return rows


def failure_masks(docs: DataFrame, labels: DataFrame, *, key: str, text: str, part: str) -> DataFrame:
    """(part, mask, documents, good, toxic): how many rows of each part fail which filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = text_bytes(batch.column("text"))
            masks = pa.array([failures(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("part"), masks, digests], ["key", "part", "mask", "digest"])

    slim = docs.select(col(key).alias("key"), F.coalesce(col(part).cast("string"), F.lit("")).alias("part"), col(text).alias("text"))
    schema = slim.select("key", "part", F.lit(0).alias("mask"), F.lit(b"").alias("digest")).schema
    seen = store(slim.mapInArrow(run, schema), "failures")
    # The first row of a text is found by key and digest, so rows that share a text are spread over their keys.
    first = seen.filter("key IS NOT NULL").groupBy("digest").agg(F.min("key").alias("key")).withColumn("first", F.lit(True))
    marks = labels.filter(col(key).isNotNull()).groupBy(col(key).alias("key")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    later = F.col("key").isNotNull() & F.col("first").isNull()
    return (
        seen.join(marks, "key", "left")
        .join(first, ["key", "digest"], "left")
        .groupBy("part", (F.col("mask") + F.when(later, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))
        .agg(
            F.count("*").alias("documents"),
            F.sum(F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """(part, STEPS): a row for every part, order of the five filters and step.

    A text fails A with under 100 words, B if fewer than 80% of its words are distinct, C
    if more than a tenth of its code points are capitals A to Z, D if it holds one of
    SYMBOLS, E if a row of a smaller key anywhere has the same text. ``labels`` has the
    key with ``quality`` and ``toxic``; of several rows a key, one suffices.

    A null text counts as empty, a null part as the empty string. Rows without a key have
    no labels, fail no E and make no other row fail it; rows that share the smallest key
    of a text all pass E. Texts of any length are read as a whole. Other columns are not
    read. An empty table gives no rows.

    Counts by part and mask are summed before they are shuffled; what is gathered for one
    part is at most 32 rows.
    """
    masks = failure_masks(docs, labels, key=key, text=text, part=part)
    cells = masks.groupBy("part").agg(F.collect_list(F.struct("mask", *WEIGHTS)).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = audit(FILTERS, {c["mask"]: tuple(c[w] for w in WEIGHTS) for c in row["cells"]})
                columns = [pa.array(c) for c in zip(*found)]
                columns[1] = columns[1].cast(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(list(repeat(row["part"], len(found))), pa.string()), *columns], names)

    schema = "part string, " + STEPS
    names = [c.split()[0] for c in schema.split(", ")]
    return cells.mapInArrow(run, schema)
