"""Benchmark decontamination: q-gram counts in diagonal bands, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import col, free_name, slices, store

Q = 8  # characters of a q-gram; folded to a byte each, one fits a 64-bit word
SHORTER = (8, 4, 2, 1)  # the longest of these for which the lemma says something is taken for an item
SPACED = "\u0e00"  # scripts before this one put spaces between words
HASH_BITS = 22
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str | None) -> str:
    """Lower case, with every run of white space as one space."""
    return " ".join((text or "").replace("\0", " ").lower().split())


def fold(points: np.ndarray) -> np.ndarray:
    """Code points as bytes: ASCII as it is, others by a hash. Equal characters stay equal."""
    out = points.astype(np.uint8)
    far = points > 127
    if far.any():
        out[far] = (points[far] * np.uint32(2654435761) >> np.uint32(21)).astype(np.uint8) | 128
    return out


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """The q-gram that starts at every position, as one integer; q is a power of two."""
    out, size = codes.astype(np.uint64), 1
    while size < q:
        out = out[:-size] | out[size:] << np.uint64(8 * size)
        size *= 2
    return out


def gram_size(length: int, rate: float) -> int:
    """The longest q-gram for which the lemma says something about an item."""
    return next((q for q in SHORTER if length + 1 - q * (int(length * rate) + 1) > 0), 1)


def slots(g: np.ndarray) -> np.ndarray:
    return (g * MULTIPLIER) >> np.uint64(64 - HASH_BITS)


@dataclass
class Index:
    """The q-grams of some benchmark items, ready for a scan over documents."""

    items: list[tuple[int, str]]  # id and normalised text
    rate: float
    q: int = Q
    length: np.ndarray = field(init=False)
    budget: np.ndarray = field(init=False)  # edits allowed
    least: np.ndarray = field(init=False)  # q-grams that a region within the budget must share

    def __post_init__(self) -> None:
        self.length = np.array([len(t) for _, t in self.items], np.int64)
        # The lemma says something only while length + 1 - q * (budget + 1) is positive.
        self.budget = np.minimum((self.length * self.rate).astype(np.int64), self.length // self.q - 1)
        self.least = self.length + 1 - self.q * (self.budget + 1)
        self.points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for _, t in self.items]
        every = [grams(fold(p), self.q) for p in self.points]
        owner = np.concatenate([np.full(len(g), i, np.int64) for i, g in enumerate(every)])
        offset = np.concatenate([np.arange(len(g)) for g in every])
        flat = np.concatenate(every)
        order = np.argsort(flat, kind="stable")
        self.grams, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.owner, self.offset = owner[order], offset[order]
        self.present = np.zeros(1 << HASH_BITS, bool)
        self.present[slots(self.grams)] = True

    def candidates(self, points: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, item, first and last diagonal) of every region that may be within the budget.

        ``points`` holds all documents one after another, ``bounds`` where they begin.
        A match with at most k edits keeps its q-grams within k diagonals of each other,
        so bands of twice the width k + 1 that overlap by half hold all of them.
        """
        if len(points) < self.q:
            return []
        g = grams(fold(points), self.q)
        at = np.flatnonzero(self.present[slots(g)])
        where = np.searchsorted(self.grams, g[at])
        where[where == len(self.grams)] = 0
        hit = self.grams[where] == g[at]
        at, where = at[hit], where[hit]
        doc = np.searchsorted(bounds, at, side="right") - 1
        n = self.count[where]
        which = np.repeat(np.arange(len(at)), n)
        entry = self.first[where][which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        item = self.owner[entry]
        # A pair with fewer shared q-grams in all has no band with enough.
        pair = doc[which] * len(self.items) + item
        if len(bounds) * len(self.items) < 1 << 24:
            shared = np.bincount(pair, minlength=1)[pair]
        else:
            _, own, times = np.unique(pair, return_inverse=True, return_counts=True)
            shared = times[own]
        keep = np.flatnonzero(shared >= self.least[item])
        which, entry, item = which[keep], entry[keep], item[keep]
        longest = int(self.length.max())  # keeps diagonals from being negative
        diagonal = (at - bounds[doc])[which] - self.offset[entry] + longest
        band = diagonal // (self.budget[item] + 1)
        key, hits = self._count(item, doc[which], band, self.offset[entry])
        beside = np.zeros(len(hits), np.int64)
        if len(hits) > 1:
            next_band = (key[0, 1:] == key[0, :-1]) & (key[1, 1:] == key[1, :-1]) & (key[2, 1:] == key[2, :-1] + 1)
            beside[:-1] = np.where(next_band, hits[1:], 0)
        enough = np.flatnonzero(hits + beside >= self.least[key[0]])
        width = self.budget[key[0, enough]] + 1
        low = key[2, enough] * width - longest
        return list(zip(key[1, enough].tolist(), key[0, enough].tolist(), low.tolist(), (low + 2 * width).tolist()))

    @staticmethod
    def _count(item: np.ndarray, doc: np.ndarray, band: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (item, document, band) in order, and how many of the item's q-grams each has."""
        docs, bands, offsets = (int(x.max(initial=0)) + 1 for x in (doc, band, offset))
        flat = (item * docs + doc) * bands + band
        if (int(item.max(initial=0)) + 1) * docs * bands * offsets < 1 << 62:
            flat = np.sort(flat * offsets + offset)
            flat = flat[np.diff(flat, prepend=-1) != 0] // offsets
        else:  # long items in many bands: the two do not fit one integer
            order = np.lexsort((offset, flat))
            flat, offset = flat[order], offset[order]
            flat = flat[(np.diff(flat, prepend=-1) != 0) | (np.diff(offset, prepend=-1) != 0)]
        starts = np.flatnonzero(np.diff(flat, prepend=-1))
        key, hits = flat[starts], np.diff(starts, append=len(flat))
        return np.stack([key // bands // docs, key // bands % docs, key % bands]), hits


def align(pattern: np.ndarray, text: np.ndarray, first: int, last: int, budget: int) -> tuple[int, int, int] | None:
    """Best (edits, start, end) of ``pattern`` in ``text`` on a path inside a band of diagonals.

    Only diagonals (text position less pattern position) within ``budget`` of first to
    last are filled in: a path with at most ``budget`` edits that touches the band cannot
    leave that margin. None if no region is within the budget.
    """
    low, high = first - budget, last + budget
    width = high - low + 1
    padded = np.zeros(width + len(pattern) + 1, np.uint32)  # text from position low on, 0 where there is none
    begin, end = max(0, low), min(len(text), low + len(padded))
    if end > begin:
        padded[begin - low : end - low] = text[begin:end]
    ramp = np.arange(width)
    far = budget + 1
    position = low + ramp  # a path may start before any text character
    cost = np.where((position >= 0) & (position <= len(text)), 0, far)
    origin = position.copy()
    for i, c in enumerate(pattern):
        inside = (low + i + 1 + ramp >= 0) & (low + i + 1 + ramp <= len(text))
        matched = cost + (padded[i : i + width] != c)
        dropped = np.append(cost[1:], far) + 1  # the pattern character has no partner
        step = np.minimum(matched, dropped)
        start = np.where(matched <= dropped, origin, np.append(origin[1:], 0))
        # Text characters without a partner: the best cell to the left plus the way from it.
        slope = step - ramp
        best = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == best, ramp, 0))
        cost = np.where(inside, best + ramp, far)
        origin = start[source]
        if cost.min() > budget:
            return None
    at = int(cost.argmin())
    return int(cost[at]), int(origin[at]), int(low + len(pattern) + at)


def inside_word(text: str, at: int) -> bool:
    """Whether a word of a script with spaces between words goes on from before ``at``."""
    pair = text[max(0, at - 1) : at + 1] if at else ""
    return len(pair) == 2 and all(c.isalnum() and c < SPACED for c in pair)


def exact(text: str, item: str, whole_words: bool) -> int:
    """Where ``item`` stands in ``text`` first, or -1."""
    at = text.find(item)
    while whole_words and at >= 0 and (inside_word(text, at) or inside_word(text, at + len(item))):
        at = text.find(item, at + 1)
    return at


def matches(index: Index, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, item, edits, start, end) of the best region for every item that a document holds."""
    parts = [t + "\0" * Q for t in texts]  # no q-gram of an item reaches over a gap
    bounds = np.cumsum([0, *map(len, parts[:-1])])
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    sought: set[tuple[int, int]] = set()
    for doc, item, first, last in index.candidates(points, bounds):
        old = best.get((doc, item))
        if old and old[0] == 0:
            continue
        budget = int(index.budget[item])
        if (doc, item) not in sought:
            sought.add((doc, item))
            at = exact(texts[doc], index.items[item][1], budget == 0)
            if at >= 0:
                best[doc, item] = (0, at, at + int(index.length[item]))
                continue
        if budget == 0:
            continue
        begin = int(bounds[doc])
        text = points[begin : begin + len(texts[doc])]
        found = align(index.points[item], text, first, last, budget)
        if found and (old is None or found < old):
            best[doc, item] = found
    for (doc, item), (edits, start, end) in sorted(best.items()):
        yield doc, item, edits, start, end


def chunks(benchmark: DataFrame, item: str, text: str, rate: float, chunk_chars: int) -> Iterator[tuple[int, list[Index]]]:
    """Indexes over benchmark items with their characters, about ``chunk_chars`` together or one longer item.

    Rows come to the driver a partition at a time, so what is held and sent is bounded by
    the chunk and not by the benchmark.
    """
    rows = benchmark.select(col(item).alias("item"), col(text).alias("text")).filter("item IS NOT NULL AND text IS NOT NULL")
    held: dict[int, list[tuple[int, str]]] = {}
    size = 0
    for r in rows.distinct().toLocalIterator():
        t = normalise(r["text"])
        if not t:
            continue
        if size + len(t) > chunk_chars and held:
            yield size, [Index(items, rate, q) for q, items in held.items()]
            held, size = {}, 0
        held.setdefault(gram_size(len(t), rate), []).append((r["item"], t))
        size += len(t)
    if held:
        yield size, [Index(items, rate, q) for q, items in held.items()]


def scan(docs: DataFrame, parts: list[Broadcast], text: str, mark: str) -> DataFrame:
    """Every row of ``docs`` with its matches in the indexes of all parts added to its array ``mark``; texts are read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 1 << 21):
            at = batch.schema.get_field_index(mark)
            found: list[list[dict]] = batch.column(at).to_pylist()
            texts = [normalise(t) for t in batch.column(text).to_pylist()]
            for shared in parts:
                for own in shared.value:
                    for doc, item, edits, start, end in matches(own, texts):
                        found[doc].append({"item": own.items[item][0], "distance": edits, "start": start, "end": end})
            yield batch.set_column(at, mark, pa.array(found, batch.schema.types[at]))

    return docs.mapInArrow(run, docs.schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    rate: float = 0.1,
    chunk_chars: int = 1 << 20,
    held_chars: int = 1 << 22,
    mark: str = "matches",
) -> DataFrame:
    """``docs`` with ``mark``, an array of (item, distance, start, end): benchmark items that the text holds.

    An item is held if some region of the normalised text (lower case, single spaces) is
    within an edit distance of ``rate`` times the item's length; start and end are that
    region's character positions there. All such items are found: a region within the
    budget shares the number of q-grams that the lemma demands, in one band; the shorter
    the item, the shorter its q-grams. Items too short for a single edit must stand there as
    whole words, where the script has spaces. Every item with a character other than white
    space is sought, by this one rule at every length. A null or empty text holds nothing,
    a text of any length is searched as a whole; an empty table gives no rows, an empty
    benchmark leaves every array empty. Repeated rows stay; benchmark rows that repeat
    count once. A column of ``docs`` that is called ``mark`` is replaced.

    A benchmark is sent in parts of ``chunk_chars`` characters. Workers hold parts of about
    ``held_chars`` together (and at least one item), at some 40 bytes a character. A larger
    benchmark takes several passes over the texts; rows are written between them, so that
    neither the driver nor a worker holds more than the parts of one pass.
    """
    found = docs.drop(mark).withColumn(mark, F.expr("CAST(array() AS array<struct<item:bigint,distance:bigint,start:bigint,end:bigint>>)"))
    context = docs.sparkSession.sparkContext
    parts, held = [], 0
    for size, indexes in chunks(benchmark, item, item_text, rate, chunk_chars):
        if parts and held + size > held_chars:
            found = store(scan(found, parts, text, mark), "decontam_pass")
            for part in parts:
                part.destroy()  # what it was for is written
            parts, held = [], 0
        parts.append(context.broadcast(indexes))
        held += size
    return scan(found, parts, text, mark) if parts else found


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    mark = free_name(docs, "matches")
    found = contamination(docs, benchmark, mark=mark, **options)
    return found.filter(F.size(mark) == 0).drop(mark)
