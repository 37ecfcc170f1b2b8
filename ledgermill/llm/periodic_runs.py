"""Runs of words that repeat with a period, found by string synchronising sets.

For every power of two t from 4, a position is chosen if, among the hashes of the t words
that start at it and at the next t positions, the least is at either end. Positions whose
t words lie inside a run of period t/4 or less do not count. So whether a position is
chosen depends on the 2t words from it only, and any 3t - 1 words that are not such a run
hold a chosen one. A run of four periods p, t <= p < 2t, therefore has a chosen position
in its first t words and another one p further with the same 2t words, and none with them
between. Each chosen position and the next with the same 2t words propose their distance,
which is compared word by word both ways. Periods below 4, and with them the regions left
out at larger scales, are found by comparing the words with themselves 1 to 3 places on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import col, slices, text_bytes

PERIODS = 4  # a run holds its period at least so often
BASE = 4  # least scale
MOST = np.iinfo(np.uint64).max
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def onward(x: np.ndarray, by: int, filling: int) -> np.ndarray:
    """``x`` moved ``by`` places towards the start."""
    return np.concatenate([x[by:], np.full(min(by, len(x)), filling, x.dtype)])


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    return mix(x * np.uint64(0x9E3779B97F4A7C15) + y)


def small_periods(codes: np.ndarray, text: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of periods below BASE."""
    runs = []
    for p in range(1, BASE):
        same = (codes[p:] == codes[:-p]) & (text[p:] == text[:-p])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        for s, e in edges.reshape(-1, 2)[np.diff(edges)[::2] >= (PERIODS - 1) * p].tolist():
            if p == 1 or (codes[s : s + p] != codes[s]).any():  # else the same word again and again
                runs.append((s, e + p, p))
    return runs


def equal_ahead(codes: np.ndarray, at: int, p: int, stop: int) -> int:
    """First place from ``at`` whose word differs from that ``p`` places on, at most ``stop``."""
    step = 64
    while at < stop:
        upto = min(stop, at + step)
        wrong = codes[at:upto] != codes[at + p : upto + p]
        if wrong.any():
            return at + int(wrong.argmax())
        at, step = upto, step * 2
    return at


def equal_behind(codes: np.ndarray, at: int, p: int, stop: int) -> int:
    """First place of the stretch up to ``at`` whose words equal those ``p`` places on, at least ``stop``."""
    step = 64
    while at > stop:
        start = max(stop, at - step)
        wrong = codes[start:at] != codes[start + p : at + p]
        if wrong.any():
            return at - int(wrong[::-1].argmax())
        at, step = start, step * 2
    return at


def chosen_positions(label: np.ndarray, left: np.ndarray, t: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The synchronising set: ``label`` hashes the t words from each position, ``left`` counts the words to its text's end."""
    n = len(label)
    label = label.copy()
    label[left < t] = MOST
    covered = np.zeros(n + 1, np.int64)
    for s, e, p in runs:
        if p * PERIODS <= t <= e - s:
            covered[s] += 1
            covered[e - t + 1] -= 1
    label[np.cumsum(covered)[:n] > 0] = MOST
    least, width = label, 1
    while width < t:
        least = np.minimum(least, onward(least, width, MOST))
        width *= 2
    least = np.minimum(least, onward(least, 1, MOST))
    ends = (least == label) | (least == onward(label, t, MOST))
    return np.flatnonzero(ends & (least != MOST) & (left >= 2 * t))


def find_runs(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of four or more periods, by text, start and period.

    ``codes`` numbers the words of all texts one after another, ``sizes`` counts them.
    A run has its smallest period and cannot be made longer.
    """
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    left = ends[text] - np.arange(len(codes))
    runs = set(small_periods(codes, text))
    place = np.arange(len(codes))  # of the positions that still take part
    hashes = mix(codes.astype(np.uint64) + np.uint64(1))
    t = 1
    while True:
        if t >= BASE:
            runs |= propose(codes, sizes, ends, text, left, place, hashes, t, runs)
        stay = np.repeat(sizes >= 2 * t * PERIODS, sizes)[place]
        if not stay.any():
            break
        hashes = joined(hashes, onward(hashes, t, 0))[stay]
        place = place[stay]
        t *= 2
    found = np.array(sorted(runs), np.int64).reshape(-1, 3)
    owner = text[found[:, 0]] if len(found) else np.empty(0, np.int64)
    return np.stack([owner, found[:, 0] - (ends - sizes)[owner], found[:, 1] - found[:, 0], found[:, 2]], axis=1)


def propose(codes, sizes, ends, text, left, place, hashes, t, runs) -> set[tuple[int, int, int]]:
    """Runs of periods from t to 2t - 1."""
    where = np.full(len(codes) + 1, len(place), np.int64)  # from a place to its index among those that take part
    where[place] = np.arange(len(place))
    near = [(int(where[s]), int(where[s]) + e - s, p) for s, e, p in runs if p * PERIODS <= t <= e - s and where[s] < len(place)]
    at = chosen_positions(mix(hashes ^ np.uint64(t)), left[place], t, near)
    key = joined(joined(hashes[at], hashes[at + t]), text[place[at]].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    one, two = place[at[order[:-1][same]]], place[at[order[1:][same]]]
    period = two - one
    fits = (period >= t) & (period < 2 * t) & (text[one] == text[two])
    one, period = one[fits], period[fits]
    order = np.lexsort((one, period))
    one, period = one[order], period[order]
    # Proposals of one period that overlap lie in the same run.
    fresh = np.ones(len(one), bool)
    fresh[1:] = (np.diff(period) != 0) | (np.diff(one) > 2 * t) | (text[one[1:]] != text[one[:-1]])
    found = set()
    for i, p in zip(one[fresh].tolist(), period[fresh].tolist()):
        end = int(ends[text[i]])
        s = equal_behind(codes, i, p, end - int(sizes[text[i]]))
        e = equal_ahead(codes, i, p, end - p) + p
        if e - s >= PERIODS * p:
            found.add((s, e, p))
    return found


class Numbers(dict):
    """Numbers words as they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def echoed(words: list[bytes], h: int) -> list[bytes]:
    """For a hash divisible by 10, from a word on that the hash tells the words that follow it, again and again."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def collapse(texts: list[list[bytes]], least: int) -> tuple[np.ndarray, list[bytes]]:
    """Rows as ``find_runs`` gives them for runs of at least ``least`` words; the words of each text that stay, joined."""
    number = Numbers()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.fromiter((number[w] for words in texts for w in words), np.int64, int(sizes.sum()))
    runs = find_runs(codes, sizes)
    runs = runs[runs[:, 2] >= least]
    kept = {}
    for i, start, length, period in runs.tolist():
        if i not in kept:
            kept[i] = np.ones(len(texts[i]), bool)
        kept[i][start + period : start + length] = False
    out = [b" ".join(words if i not in kept else [words[k] for k in np.flatnonzero(kept[i]).tolist()]) for i, words in enumerate(texts)]
    return runs, out


def collapse_runs(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = 6,
    rewrite: Callable[[list[bytes], object], list[bytes]] | None = None,
) -> DataFrame:
    """(key, n_words, runs, collapsed) of every row: all runs by start and period, and the text without their repeats.

    A run is a stretch of words with smallest period q, of at least ``least`` and at
    least 4q words, that no neighbouring word extends. ``collapsed`` joins by a space the
    words that no run holds after its first q words. ``rewrite(words, key)`` may change
    the words first. A null, empty or blank text has no words, no runs and an empty
    collapsed text. Keys may be null, repeat or have any type; every row gives one row.
    Texts of any length are read as a whole, in memory in proportion to them. Other
    columns are neither read nor returned. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [t.split() for t in text_bytes(batch.column("text"))]
            if rewrite is not None:
                words = [rewrite(w, k) for w, k in zip(words, batch.column("key").to_pylist())]
            runs, texts = collapse(words, least)
            edge = np.searchsorted(runs[:, 0], np.arange(len(words) + 1)).astype(np.int32)
            fields = [pa.array(np.ascontiguousarray(runs[:, i + 1])) for i in range(3)]
            held = pa.ListArray.from_arrays(pa.array(edge), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            n = pa.array(np.fromiter(map(len, words), np.int64, len(words)))
            out = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), n, held, out], ["key", "n_words", "runs", "collapsed"])

    slim = docs.select(col(key).alias("key"), col(text).alias("text"))
    schema = slim.select(
        "key", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUN).alias("runs"),
        F.lit("").alias("collapsed"),
    ).schema
    return slim.mapInArrow(run, schema).toDF(key, "n_words", "runs", "collapsed")
