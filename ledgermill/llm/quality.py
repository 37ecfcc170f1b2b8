"""Quality rules as weak supervision: rules vote or abstain, EM learns how far to trust each."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import col, slices, store, text_bytes

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = bytes(range(ord("a"), ord("z") + 1))
LETTERS = UPPER + LOWER + bytes(range(0x80, 0x100))
NOT_LETTERS = bytes(b for b in range(256) if b not in LETTERS)
SENTENCE_END = (b".", b"?", b"!", b'."', b".)")

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower",
    "n_bare", "n_ends", "n_shouts", "n_top", "n_letter_bytes", "n_solid_bytes",
)


def repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words that lie in a three-word window found at least twice, and how often the most frequent word is found."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    top = int(np.bincount(ids).max()) if len(ids) else 0
    if len(ids) < 4:
        return 0, top
    pair = ids[:-2] * len(number) + ids[1:-1]
    if len(number) >= 1 << 20:  # keep the triples within 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    triple = pair * len(number) + ids[2:]
    order = np.argsort(triple, kind="stable")
    same = np.diff(triple[order]) == 0
    again = np.zeros(len(triple), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum()), top


def measure(text: bytes) -> tuple[int, ...]:
    """The COUNTS of one text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats, top = repeat_words(words)
    return (
        len(words),
        len(text.translate(None, SPACE + CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        len(lines),
        len(text) - len(text.translate(None, UPPER)),
        len(text) - len(text.translate(None, LOWER)),
        sum(not w.translate(None, NOT_LETTERS) for w in words),
        sum(w.endswith(SENTENCE_END) for w in words),
        sum(w.endswith(b"!!") for w in words),
        top,
        len(text.translate(None, NOT_LETTERS)),
        len(text.translate(None, SPACE)),
    )


def measures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, COUNTS) of every row: one pass over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            table = np.array([measure(t) for t in text_bytes(batch.column("text"))], np.int64).reshape(-1, len(COUNTS))
            columns = [pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], ["key", *COUNTS])

    slim = docs.select(col(key).alias("key"), col(text).alias("text"))
    schema = slim.select("key", *[F.lit(0).cast("long").alias(c) for c in COUNTS]).schema
    return slim.mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """Votes bad (-1) if a ratio lies outside ``fair``, good (1) if it lies in ``good``, else abstains (0).

    Most rules know one kind of junk and say nothing about other texts.
    """

    name: str
    part: str
    whole: str
    fair: tuple[float, float]
    good: tuple[float, float] | None = None

    def vote(self) -> Column:
        ratio = F.col(self.part) / F.col(self.whole)
        said = F.when(~ratio.between(*self.fair), -1)
        if self.good:
            said = said.when(ratio.between(*self.good), 1)
        return F.when(F.col(self.whole) > 0, said.otherwise(0)).otherwise(0).cast("int").alias(self.name)


RULES = (
    Rule("sentences", "n_ends", "n_words", (0.01, 0.60), (0.03, 0.30)),
    Rule("letters", "n_letter_bytes", "n_solid_bytes", (0.80, 1), (0.93, 1)),
    Rule("symbols", "n_symbols", "n_words", (0, 0.10)),
    Rule("bare_words", "n_bare", "n_words", (0, 0.10)),
    Rule("repetition", "n_repeat_words", "n_words", (0, 0.30)),
    Rule("top_word", "n_top", "n_words", (0, 0.25)),
    Rule("shouting", "n_shouts", "n_words", (0, 0.10)),
    Rule("capitals", "n_upper", "n_letters", (0, 0.30)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", (0, 0.40)),
    Rule("word_length", "word_chars", "n_words", (2, 16)),
)
VOTES = (-1, 0, 1)


@dataclass
class Trust:
    """What EM has learnt: the share of good documents, and each rule's chances of its three votes by class."""

    share: float
    on_good: np.ndarray  # rules x votes
    on_bad: np.ndarray
    rounds: int

    def odds(self, votes: list[Column]) -> Column:
        """Log odds that a document is good, from its votes."""
        total = F.lit(float(np.log(self.share / (1 - self.share))))
        weights = np.log(self.on_good / self.on_bad)
        for vote, w in zip(votes, weights.tolist()):
            total = total + F.when(vote == -1, w[0]).when(vote == 1, w[2]).otherwise(w[1])
        return total


def chances(cast: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """How often each rule casts each vote in a class; one imagined vote of each kind keeps it off 0."""
    return (np.einsum("p,prv->rv", weight, cast) + 1) / (weight.sum() + len(VOTES))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9) -> Trust:
    """Expectation-maximisation over vote patterns and how many documents have each.

    Every rule has its own chances of voting bad, abstaining or voting good on either
    class. Documents start in the class that their votes lean to (good if they do not
    lean), and a rule's bad vote is held to be no likelier on good documents than on bad
    ones, so the classes cannot change places.
    """
    cast = np.stack([patterns == v for v in VOTES], axis=2).astype(float)
    good = np.where(patterns.sum(axis=1) >= 0, 0.9, 0.1)
    total, before, step = counts.sum(), -1.0, 0
    for step in range(1, rounds + 1):
        share = float((counts @ good + 1) / (total + 2))
        on_good, on_bad = chances(cast, counts * good), chances(cast, counts * (1 - good))
        turned = on_good[:, 0] > on_bad[:, 0]
        on_good[turned] = on_bad[turned] = chances(cast, counts)[turned]
        odds = np.log(share / (1 - share)) + np.einsum("prv,rv->p", cast, np.log(on_good / on_bad))
        good = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        if abs(share - before) < tolerance:
            break
        before = share
    return Trust(share, on_good, on_bad, step)


def judge(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, COUNTS, the rules' votes, quality, base_failed, kept) of every row of ``docs``.

    ``quality`` is the posterior probability that the document is good. ``base_failed``
    marks texts of fewer than 50 words and those with over half of their words in
    repeated three-word windows; ``kept`` is false for them and else tells whether
    ``quality`` reaches ``threshold``. Null and empty texts have counts of 0, no votes and
    fail the base rules; a text of any length is read as a whole. Repeated rows count each time. An empty table gives no rows.
    Only vote patterns and their numbers reach the driver, at most three to the power of
    the number of rules.
    """
    found = measures(docs, key, text).withColumn("n_letters", F.col("n_upper") + F.col("n_lower"))
    names = [r.name for r in RULES]
    found = store(found.select("key", *COUNTS, *[r.vote() for r in RULES]), "quality")
    seen = found.groupBy(*names).agg(F.count("*").alias("documents")).collect()
    patterns = np.array([[r[n] for n in names] for r in seen], np.int64).reshape(-1, len(names))
    trust = estimate(patterns, np.array([r["documents"] for r in seen], np.float64))
    quality = 1 / (1 + F.exp(-trust.odds([F.col(n) for n in names])))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select(
        F.col("key").alias(key), *COUNTS, *names, quality.alias("quality"), failed.alias("base_failed"),
        (~failed & (quality >= threshold)).alias("kept"),
    )
