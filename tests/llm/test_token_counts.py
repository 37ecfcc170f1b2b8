from collections import Counter

import public_tokenizers as P

from ledgermill.llm.token_counts import encoding, token_counts
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes

PATH = P.path("byte_bpe_50k.tiktoken")


def brute(texts):
    encode = encoding(PATH, P.PATTERN).encode_ordinary
    sizes = [len(encode(t or "")) for t in texts]
    n, total = len(sizes), sum(sizes)
    return {
        s: (
            c,
            sum(x > s for x in sizes),
            sum(x for x in sizes if x > s),
            sum(x <= s for x in sizes),
            sum(x for x in sizes if x <= s),
            sum(min(x, s) for x in sizes),
            total - sum(min(x, s) for x in sizes),
            sum(x <= s for x in sizes) / n,
        )
        for s, c in Counter(sizes).items()
    }


def check(df):
    got = token_counts(df, PATH, P.PATTERN).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute([r.text for r in df.select("text").collect()]) and len(got) == len({r[0] for r in got})


def test_every_limit_equals_brute_force(spark):
    check(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_odd_rows_and_names(docs):
    check(with_clashes(odd(docs)))


def test_lengths_in_many_blocks(docs):
    check(docs(*[(i, "a b " * (i * 700)) for i in range(30)]))


def test_empty_table(docs):
    assert token_counts(docs((1, "a")).limit(0), PATH, P.PATTERN).count() == 0


def test_special_tokens_are_ordinary_text(docs):
    rows = token_counts(docs((1, "<|endoftext|>")), PATH, P.PATTERN).collect()
    assert rows[0].context_limit > 1
