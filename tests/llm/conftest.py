import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
PROSE = {
    "en": "the thing that was here and then over there with them is not this other thing they heard of",
    "de": "der und die das nicht ist ein eine auch auf für über schön größe möchte zwischen gegen werden",
    "fr": "le la les des une être été où déjà avec pour dans qui que très élève français garçon même",
}


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text[, lang, source]) tuples, over a few partitions."""

    def make(*rows, parts=3):
        full = [(r + (None,) * 4)[:4] for r in rows]
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in full]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


def odd(docs):
    """Rows no operator may stumble over: nulls everywhere, empty, blank, very long, repeated."""
    long = " ".join(f"word{i % 997} runs on" for i in range(60_000))
    return docs(
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n ", "en", "a"),
        (4, long, "en", "b"),
        (5, "one", "de", None),
        (6, "same text here", "en", "b"),
        (6, "same text here", "en", "b"),
        (None, "no key at all", "fr", "b"),
        (None, None, None, None),
        (7, "×××\n\n---\n12 34", None, "ü"),
    )


# Columns that operators use inside, some in other case.
CLASHES = (
    "key", "fp", "fingerprint", "digest", "text_digest", "cell", "size", "shard", "slot", "pass", "turn", "copies", "mix_cell",
    "matches", "matches_0", "lang_pred", "lang_score", "HAS_LETTER", "component", "who", "n", "mask", "line_doc", "doc",
    "row_number", "row_place", "feistel_left", "words", "uid", "rank", "n_lines", "n_deleted", "mix_block", "weight", "total",
)


def with_clashes(df, *without):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHES if c not in without and c.lower() not in {w.lower() for w in without}})
