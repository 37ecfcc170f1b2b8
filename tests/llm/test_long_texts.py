"""Very long texts of every shape, through the operators that have no such test of their own."""

import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import lang_id, line_dedup, lm_score, mixing, quality, sharding, simhash, token_counts


@pytest.fixture(scope="module")
def long(docs):
    rng = random.Random(3)
    unbroken = "".join(rng.choice("etaoinshrdlu") for _ in range(400_000))
    lines = "\n".join(f"line {i % 50_000} of many" for i in range(150_000))
    return docs(
        (1, unbroken, "en", "a"), (2, lines, "en", "a"), (3, "\n" * 300_000, "en", "b"), (4, " " * 300_000 + "one", "de", "b"),
        (5, "ein kurzer Text", "de", "b"), (6, unbroken, "en", "b"),
    )


def test_token_counts(long):
    rows = token_counts.token_counts(long, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert sum(r.documents for r in rows) == 6


def test_mixing(long):
    size = {r.doc_id: r["size"] for r in mixing.mix_report(long).collect()}
    assert size == {1: 1, 2: 600_000, 3: 0, 4: 1, 5: 3, 6: 1}
    assert set(r.doc_id for r in mixing.mix_sources(long).select("doc_id").collect()) <= set(size)


def test_sharding(long):
    rows = sharding.shard_rows(long, shards=3).select("shard", "slot").collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(3) for k in range(2)]


def test_line_dedup(long):
    got = {r.doc_id: (r.n_lines, r.n_deleted) for r in line_dedup.drop_repeated_lines(long).drop("text").collect()}
    # A word of any length is one word, too few for a run; the lines of 2 come three times.
    assert got[1] == got[6] == (1, 0) and got[3] == (300_001, 0) and got[2] == (150_000, 100_000)


def test_simhash(long):
    found = {r.doc_id: r.component_id for r in simhash.components(long).collect()}
    assert found[6] == found[1] == 1 and found[3] == 3 and len(found) == 6


def test_quality(long):
    got = {r.doc_id: r.n_words for r in quality.judge(long).collect()}
    assert got == {1: 1, 2: 600_000, 3: 0, 4: 1, 5: 3, 6: 1}


def test_lm_score(long):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = {r.doc_id: r for r in lm_score.score_documents(long, path, P.PATTERN, vocabulary=50_256).collect()}
    assert rows[1].score == pytest.approx(rows[6].score) and rows[3].n_tokens == 1 and rows[2].n_tokens == 600_001
    assert all(r.score < 0 for r in rows.values())


def test_lang_id(long):
    rows = {r.doc_id: r for r in lang_id.identify_language(long).select("doc_id", "lang_pred", F.col("lang_score").alias("s")).collect()}
    assert rows[3].lang_pred == lang_id.UNKNOWN and rows[1].lang_pred == rows[6].lang_pred and len(rows) == 6
