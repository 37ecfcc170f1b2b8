import re
from collections import Counter

import numpy as np
import pytest

from ledgermill.llm import quality
from ledgermill.llm.common import documents
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(repeated),
    )


TEXTS = ["", " ", "a", "a b", "a b c", "a a a a", "a b c a b c", "x y z w x y z", "é\nè\né\n\n\n é", "# * $ | <é>", "a b\x0bc\x1cd e", "one two " * 40]


@pytest.mark.parametrize("text", TEXTS)
def test_counts_of_odd_texts(text):
    assert quality.measure(text.encode())[:5] == slow_counts(text)


def test_counts_of_all_documents(spark):
    texts = {r.doc_id: r.text or "" for r in documents(spark, SMALL).collect()}
    rows = quality.judge(documents(spark, SMALL)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, dup, rep = slow_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert r.kept == (not r.base_failed and r.quality >= 0.5)


def test_many_distinct_words(monkeypatch):
    words = [f"w{i}".encode() for i in range(3000)] * 2
    full = quality.repeat_words(words)
    assert full == (6000, 2)


def test_votes_agree_with_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in quality.judge(documents(spark, "/root/testdata/sf0.01")).collect() if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in rows if labels[r.doc_id] == 1]
    bad = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_estimation_recovers_the_chances_that_made_the_votes():
    rng = np.random.default_rng(2)
    n, share = 40_000, 0.8
    truth = rng.random(n) < share
    on_good = np.array([[0.02, 0.18, 0.8], [0.05, 0.95, 0.0], [0.1, 0.3, 0.6], [0.02, 0.98, 0.0]])
    on_bad = np.array([[0.6, 0.3, 0.1], [0.5, 0.5, 0.0], [0.7, 0.2, 0.1], [0.4, 0.6, 0.0]])
    chances = np.where(truth[:, None, None], on_good[None], on_bad[None])
    votes = (rng.random((n, 4, 1)) > chances.cumsum(axis=2)[:, :, :2]).sum(axis=2) - 1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    trust = quality.estimate(patterns, counts.astype(float))
    assert abs(trust.share - share) < 0.02
    assert np.abs(trust.on_good - on_good).max() < 0.03 and np.abs(trust.on_bad - on_bad).max() < 0.05


def test_odd_rows_and_names(docs):
    df = with_clashes(odd(docs))
    rows = quality.judge(df).collect()
    assert len(rows) == df.count()
    assert all(0 <= r.quality <= 1 for r in rows)
    assert {r.n_words for r in rows if r.doc_id in (1, 2, 3)} == {0} and all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3))


def test_empty_table(docs):
    assert quality.judge(docs((1, "a")).limit(0)).count() == 0


def slow_posterior(votes, trust):
    """The chance that a document is good, multiplied out rule by rule."""
    good, bad = trust.share, 1 - trust.share
    for rule, vote in enumerate(votes):
        good *= trust.on_good[rule][quality.VOTES.index(vote)]
        bad *= trust.on_bad[rule][quality.VOTES.index(vote)]
    return good / (good + bad)


def slow_estimate(all_votes):
    """Expectation-maximisation document by document."""
    rules, kinds = len(all_votes[0]), len(quality.VOTES)
    good = [0.9 if sum(v) >= 0 else 0.1 for v in all_votes]
    n, before = len(all_votes), -1.0
    for _ in range(200):
        share = (sum(good) + 1) / (n + 2)
        on = [np.zeros((rules, kinds)), np.zeros((rules, kinds)), np.zeros((rules, kinds))]
        for votes, g in zip(all_votes, good):
            for rule, vote in enumerate(votes):
                for table, w in zip(on, (g, 1 - g, 1)):
                    table[rule, quality.VOTES.index(vote)] += w
        on = [(t + 1) / (w + kinds) for t, w in zip(on, (sum(good), n - sum(good), n))]
        for rule in range(rules):
            if on[0][rule, 0] > on[1][rule, 0]:
                on[0][rule] = on[1][rule] = on[2][rule]
        trust = quality.Trust(share, on[0], on[1], 0)
        good = [slow_posterior(v, trust) for v in all_votes]
        if abs(share - before) < 1e-9:
            break
        before = share
    return good


def test_verdicts_of_all_documents_by_hand(spark):
    rows = quality.judge(documents(spark, SMALL)).collect()
    posterior = slow_estimate([[r[rule.name] for rule in quality.RULES] for r in rows])
    for r, p in zip(rows, posterior):
        assert abs(r.quality - p) < 1e-6
        assert r.kept == (not r.base_failed and p >= 0.5) or abs(p - 0.5) < 1e-6
