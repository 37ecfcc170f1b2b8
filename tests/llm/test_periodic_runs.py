import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from ledgermill.llm import periodic_runs, queries
from ledgermill.llm.common import documents
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes


def slow_runs(words, least=6):
    """All (start, length, period), by trying every period from every start."""
    n, out = len(words), []
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i + p - start
            smaller = (all(words[k] == words[k + q] for k in range(start, start + length - q)) for q in range(1, p))
            if length >= max(least, 4 * p) and not any(smaller):
                out.append((start, length, p))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    out, wide = [], rng.random() < 0.5
    for _ in range(rng.randint(0, 6)):
        base = [rng.randint(0, 1 if rng.random() < 0.4 else 30) for _ in range(rng.randint(1, 40 if wide else 3))]
        base = base * rng.randint(1, 5) if rng.random() < 0.5 else base
        out += (base * 12)[: int(len(base) * rng.random() * 9)] + [rng.randint(0, 50) for _ in range(rng.randint(0, 8))]
    return out


def test_random_words():
    rng = random.Random(5)
    for _ in range(150):
        texts = [some_words(rng) for _ in range(rng.randint(1, 12))]
        codes = np.array([x for w in texts for x in w], np.int64)
        got = periodic_runs.find_runs(codes, np.array([len(w) for w in texts])).tolist()
        assert got == [[i, *r] for i, w in enumerate(texts) for r in slow_runs(w, 0)]


def test_every_period_of_long_random_blocks():
    rng = random.Random(6)
    for p in range(1, 130):
        base = [rng.randint(0, 10**6) for _ in range(p)]
        around = [[rng.randint(10**6, 10**7) for _ in range(rng.randint(0, 40))] for _ in range(2)]
        words = around[0] + base * 4 + around[1]
        runs = periodic_runs.find_runs(np.array(words), np.array([len(words)])).tolist()
        assert runs == [[0, len(around[0]), 4 * p, p]]


def test_runs_inside_runs():
    block = [1] * 20 + [2, 3] * 9 + [4]
    words = block * 5
    assert periodic_runs.find_runs(np.array(words), np.array([len(words)])).tolist() == [[0, *r] for r in slow_runs(words, 0)]


def test_chosen_positions_depend_on_their_words_only_and_leave_no_gap():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 3, 4000)
    codes[1000:2000] = codes[:1000]
    t = 8
    window = periodic_runs.mix(codes.astype(np.uint64))
    label = window.copy()
    for k in range(1, t):
        label = periodic_runs.joined(label, periodic_runs.onward(window, k, 0))
    chosen = np.zeros(len(codes), bool)
    chosen[periodic_runs.chosen_positions(label, len(codes) - np.arange(len(codes)), t, [])] = True
    inside = np.arange(1000 - 2 * t)
    assert (chosen[inside] == chosen[inside + 1000]).all()
    gaps = np.diff(np.flatnonzero(chosen[: len(codes) - 3 * t]))
    assert gaps.max() <= t and chosen.mean() < 4 / t


def test_all_documents(spark):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SMALL).collect()}
    rows = documents(spark, SMALL).collect()
    assert len(got) == len(rows)
    planted = 0
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = slow_runs(words) if len(words) < 4000 else None
        row = got[r.doc_id]
        if runs is None:
            continue
        dropped = {k for s, length, p in runs for k in range(s + p, s + length)}
        kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (None if not runs else 1000 * best[1] // best[2])
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert planted > 5


def test_collapsed_text_and_least_length(docs):
    df = docs((1, "x go go go go go y"), (2, "x go go go go go go\ty"), (3, "a b a b a b a b c"))
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.collapse_runs(df).collect()}
    assert got == {
        1: (7, [], "x go go go go go y"),
        2: (8, [(1, 6, 1)], "x go y"),
        3: (9, [(0, 8, 2)], "a b c"),
    }
    assert periodic_runs.collapse_runs(df, least=4).filter("doc_id = 1").first().collapsed == "x go y"


def test_odd_rows_and_names(docs):
    df = with_clashes(odd(docs)).withColumnRenamed("words", "RUNS")
    found = periodic_runs.collapse_runs(df)
    rows = found.collect()
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"] and len(rows) == df.count()
    assert {(r.n_words, len(r.runs), r.collapsed) for r in rows if r.doc_id in (1, 2, 3)} == {(0, 0, "")}
    assert [r.n_words for r in rows if r.doc_id == 4] == [180_000]
    assert sorted(r.collapsed for r in rows if r.doc_id == 6) == ["same text here"] * 2


def test_very_long_texts(docs):
    found = periodic_runs.collapse_runs(docs((1, "x" * 3_000_000), (2, "a b c d e\n" * 100_000), (3, "\n" * 500_000)))
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[1].n_words == 1 and not rows[1].runs
    assert rows[2].runs[0].asDict() == {"start": 0, "length": 500_000, "period": 5} and rows[2].collapsed == "a b c d e"
    assert rows[3].n_words == 0


def test_empty_table(docs):
    assert periodic_runs.collapse_runs(docs((1, "a")).limit(0)).count() == 0
