import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgermill.llm import simhash
from ledgermill.llm.common import documents
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes


def slow_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def closure(points, distance):
    """Smallest index reachable, by comparing everything with everything."""
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ points[i]) <= distance):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            parent[b] = a
    return [find(i) for i in range(len(points))]


def test_fingerprints_and_components_of_all_documents(spark):
    rows = sorted(simhash.components(documents(spark, SMALL)).collect(), key=lambda r: r.doc_id)
    texts = {r.doc_id: r.text for r in documents(spark, SMALL).collect()}
    want = [slow_fingerprint(texts[r.doc_id]) for r in rows]
    assert [r.fingerprint & (1 << 64) - 1 for r in rows] == want
    roots = closure(np.array(want, np.uint64), 3)
    assert [r.component_id for r in rows] == [rows[i].doc_id for i in roots]


def cluster(rng, n, spread):
    centre = rng.getrandbits(64)
    out = []
    for _ in range(n):
        x = centre
        for _ in range(rng.randrange(spread)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


def linked(spark, points, distance, **options):
    signed = sorted({x - (1 << 64) if x >> 63 else x for x in points})
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(4)
    edges = {(r.a, r.b) for r in simhash.links(df, distance, **options).collect()}
    index = {x: i for i, x in enumerate(signed)}
    parent = list(range(len(signed)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        i, j = sorted((find(index[a]), find(index[b])))
        parent[j] = i
    want = closure(np.array([x & (1 << 64) - 1 for x in signed], np.uint64), distance)
    assert [find(i) for i in range(len(signed))] == want
    return edges


@pytest.mark.parametrize("distance, spare", [(0, 2), (1, 3), (3, 3), (3, 5), (6, 2)])
def test_links_connect_what_brute_force_connects(spark, distance, spare):
    rng = random.Random(distance)
    points = [x for _ in range(25) for x in cluster(rng, rng.randrange(1, 30), 7)] + [0, (1 << 64) - 1, 1, 1 << 63]
    linked(spark, points, distance, spare=spare)


def test_a_dense_group_costs_few_edges_even_in_blocks(spark):
    rng = random.Random(9)
    points = cluster(rng, 1500, 3)
    plain = linked(spark, points, 3)
    in_blocks = linked(spark, points, 3, cell=64)
    n = len(set(points))
    assert len(plain) < 25 * n and len(in_blocks) < n * n / 8


def test_the_embedding_is_a_lower_bound(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 2000, dtype=np.uint64)
    b = a.copy()
    for k in range(6):
        b ^= np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64)
    bits = np.bitwise_count(a ^ b)
    bound = simhash.manhattan(a, b)
    counts = lambda x: np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(-1, 32, 2).sum(axis=2, dtype=int)
    assert (bound <= bits).all() and (bound == np.abs(counts(a) - counts(b)).sum(axis=1)).all()
    got = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long").select(simhash.embedding(F.col("fp")).alias("e")).collect()
    fields = np.array([r.e for r in got]).view(np.uint64)
    assert ((fields[:, None] >> (2 * np.arange(32, dtype=np.uint64)) & np.uint64(3)) == counts(a)).all()


def test_copies_and_blank_texts(docs):
    rows = simhash.components(docs((5, ""), (3, None), (9, " \n"), (4, "a b c d"), (8, "A  b\nC d"), (8, "a b c d"))).collect()
    got = {(r.doc_id, r.component_id) for r in rows}
    assert got == {(5, 3), (3, 3), (9, 3), (4, 4), (8, 4)} and len(rows) == 6
    assert {r.fingerprint for r in rows if r.doc_id in (3, 5, 9)} == {0}


def test_hexadecimal_form(spark):
    df = spark.createDataFrame([(-1,), (0,), (255,)], "x long").select(simhash.hex64(F.col("x")).alias("h"))
    assert [r.h for r in df.collect()] == ["f" * 16, "0" * 16, "0" * 14 + "ff"]


def test_one_row_of_each_component_stays(spark):
    df = documents(spark, SMALL)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    roots = {r.component_id for r in simhash.components(df).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(roots)


def test_odd_rows_and_names(docs):
    df = with_clashes(odd(docs))
    assert simhash.components(df).count() == df.count()
    kept = simhash.keep_one(df)
    assert set(kept.columns) == set(df.columns)
    keys = [r.doc_id for r in kept.collect()]
    # Rows 1, 2, 3 and the last null key have no words; of the equal rows 6 one stays.
    assert sorted((k is None, k or 0) for k in keys) == [(False, 1), (False, 4), (False, 5), (False, 6), (False, 7), (True, 0)]


def test_equal_keys_with_other_texts_are_rows_of_their_own(docs):
    kept = simhash.keep_one(docs((1, "a b c d e"), (1, "v w x y z"), (2, "a b c d e")))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b c d e"), (1, "v w x y z")]


def test_empty_table(docs):
    assert simhash.components(docs((1, "a")).limit(0)).count() == 0
    assert simhash.keep_one(docs((1, "a")).limit(0)).count() == 0
