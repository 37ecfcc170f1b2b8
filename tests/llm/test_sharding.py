import pytest
from pyspark.sql import functions as F

from ledgermill.llm import sharding
from ledgermill.llm.common import documents
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 7, 10, 16, 17, 100, 999, 4096])
def test_permutation_and_its_inverse(spark, rows):
    shape = sharding.Permutation.over(spark, rows, 5)
    assert shape.left * shape.right >= rows and shape.left * shape.right - rows <= shape.left
    there = shape.apply(spark.range(rows).withColumn("x", F.col("id")), "x")
    back = shape.apply(there.withColumn("y", F.col("x")), "y", inverse=True).collect()
    assert sorted(r.x for r in back) == list(range(rows))
    assert all(r.y == r.id for r in back)


def test_walks_are_as_long_as_the_longest_chain(spark):
    # Seeds whose outside values lead outside again need more than one walk.
    assert max(sharding.Permutation.over(spark, 17, seed).walks for seed in range(6)) >= 1


def placed(df, shards=8, **options):
    return sharding.shard_rows(df, shards=shards, **options)


def check(df, shards=8):
    rows = placed(df, shards).select("shard", "slot").collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == df.count()


def test_shards_are_even_without_gaps(spark):
    check(documents(spark, SMALL))
    check(documents(spark, SMALL), 3)


def test_the_same_on_any_partitioning(spark):
    df = documents(spark, SMALL)
    key = lambda d: sorted((r.doc_id, r.shard, r.slot) for r in d.collect())
    first = key(placed(df))
    assert first == key(placed(df.repartition(17, "source")))
    assert first != key(placed(df, seed=12))
    in_order = sorted(first, key=lambda r: (r[2], r[1]))
    assert [r[0] for r in in_order] != sorted(r[0] for r in in_order)


def test_place_is_computable_without_the_data(spark):
    df = documents(spark, SMALL)
    ids = sorted(r.doc_id for r in df.select("doc_id").collect())
    shape = sharding.Permutation.over(spark, len(ids), 11)
    got = {r.doc_id: r.slot * 8 + r.shard for r in placed(df).collect()}
    for r in shape.apply(spark.range(len(ids)).withColumn("x", F.col("id")), "x").collect():
        assert got[ids[r.id]] == r.x


def test_odd_rows_and_names(docs):
    df = with_clashes(odd(docs))
    check(df)
    assert set(placed(df).columns) == {*df.columns, "shard", "slot"}
    assert placed(df).select("doc_id", "text").exceptAll(df.select("doc_id", "text")).count() == 0


def test_empty_table(docs):
    assert placed(docs((1, "a")).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = placed(documents(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def xxhash64_long(value, seed):
    import xxhash

    return xxhash.xxh64_intdigest(value.to_bytes(8, "little", signed=True), seed)


def xxhash64_int(value, seed):
    import xxhash

    return xxhash.xxh64_intdigest(value.to_bytes(4, "little", signed=True), seed)


def slow_place(n, rows, seed):
    """Where row n goes: the network step by step, again while the place is outside."""
    import math

    left = max(1, math.isqrt(max(0, rows - 1)) + 1)
    right = max(1, -(-rows // left))
    x = n
    while True:
        halves, sizes = [x // right, x % right], (left, right)
        for k in range(sharding.ROUNDS):
            own = k % 2
            mixed = 42
            for part, digest in ((halves[1 - own], xxhash64_long), (seed, xxhash64_int), (k, xxhash64_int)):
                mixed = digest(part, mixed)
            mixed -= (mixed >= 1 << 63) << 64
            halves[own] = (halves[own] + mixed % sizes[own]) % sizes[own]
        x = halves[0] * right + halves[1]
        if x < rows:
            return x


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_and_slots_by_hand(spark, shards):
    df = documents(spark, SMALL)
    ids = sorted(r.doc_id for r in df.select("doc_id").collect())
    got = {r.doc_id: (r.shard, r.slot) for r in placed(df, shards).collect()}
    places = [slow_place(n, len(ids), 11) for n in range(len(ids))]
    assert sorted(places) == list(range(len(ids)))
    assert got == {d: (p % shards, p // shards) for d, p in zip(ids, places)}
