from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import mixing
from ledgermill.llm.common import documents
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes


def fill(sizes, weights=(5, 2, 1), ceiling=3):
    """Targets by sharing, capping and sharing the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(ceiling * sizes[s] for s in capped)
        spare = sum(weight[s] for s in names if s not in capped)
        level = left / spare if spare else 0
        above = {s for s in names if s not in capped and weight[s] * level > ceiling * sizes[s] + 1e-9}
        if not above:
            return {s: ceiling * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= above


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 5, None: 300},
        {"a": 1, "b": 1, "c": 1, "d": 10_000},
        {"z": 7},
        {"a": 0, "b": 50},
        {"é": 100, "z": 100, "Z": 900, "": 3, None: 1},
    ],
)
def test_targets_fill_up_to_the_ceiling(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df, mixing.WEIGHTS, 3).collect()}
    want = fill(sizes)
    assert set(got) == set(want)
    for s in want:
        assert got[s] == pytest.approx(want[s])


def report(df):
    return [r.asDict() for r in mixing.mix_report(df).collect()]


def test_taken_words_come_near_the_targets(spark):
    df = documents(spark, SMALL)
    rows = report(df.join(df.select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")).distinct()).withColumn("doc_id", F.col("doc_id") * 10 + F.col("k")))
    source = {r.doc_id: r.source for r in df.collect()}
    per = defaultdict(list)
    for r in rows:
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        per[source[r["doc_id"] // 10]].append(r)
    for rs in per.values():
        taken, target = sum(r["taken"] for r in rs), rs[0]["target"]
        assert abs(taken - target) <= max(r["size"] for r in rs) / 2 + 1
        assert rs[0]["source_size"] == sum(r["size"] for r in rs)


def test_equal_runs_and_any_partitioning(spark):
    df = documents(spark, SMALL)
    key = lambda rows: sorted((r["doc_id"], r["taken"], tuple(r["shards"])) for r in rows)
    assert key(report(df)) == key(report(df.repartition(13)))


def test_copies_agree_with_the_report_and_shards_are_even(spark):
    df = documents(spark, SMALL)
    rows = report(df)
    mixed = mixing.mix_sources(df)
    assert mixed.columns == [*df.columns, "shard", "pass", "turn"]
    copies = defaultdict(list)
    for r in mixed.select("doc_id", "shard", "pass", "turn").collect():
        copies[r.doc_id].append((r["pass"], r["shard"]))
    for r in rows:
        assert sorted(s for _, s in copies[r["doc_id"]]) == sorted(r["shards"])
        assert len({p for p, _ in copies[r["doc_id"]]}) == len(copies[r["doc_id"]])


def test_the_splitting_tree_deals_out_every_block_evenly(spark):
    balls = spark.range(1000).selectExpr("concat('s', id % 3) AS source", "cast(id AS int) AS block", "0 AS pass", "65536 AS upto")
    for shards in (1, 2, 5, 8):
        got = mixing.split(balls, shards, 3)
        counts = {r.shard: r["count"] for r in got.groupBy("shard").count().collect()}
        assert set(counts) == set(range(shards)) and max(counts.values()) - min(counts.values()) <= 3
        assert got.select("source", "block", "pass").distinct().count() == 1000
        shares = got.filter("source = 's0'").groupBy("shard").count().collect()
        assert sum(r["count"] for r in shares) == 334 and (shards == 1 or max(r["count"] for r in shares) < 334)


def drawn_one_by_one(balls, shards, seed):
    """The tree by hand: every node's urn in hashed order, the left part from its top."""
    import hashlib

    def deal(urn, low, high, level):
        if level == max(1, shards - 1).bit_length():
            return {ball: low for ball in urn}
        middle = (low + high) // 2
        order = sorted(urn, key=lambda b: (int(hashlib.md5(f"{seed}:urn:{level}:{b[0]}:{b[1]}:{b[2]}".encode()).hexdigest()[:4], 16), *b))
        mine = len(urn) * (middle - low) // (high - low)
        return deal(order[:mine], low, max(middle, low + 1), level + 1) | deal(order[mine:], middle, high, level + 1)

    return deal(balls, 0, shards, 0)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_quotas_of_shards_and_sources_equal_a_sequential_draw(spark, shards):
    balls = [(f"s{i % 3}", i // 2, i % 2) for i in range(300)]
    df = spark.createDataFrame([(*b, 65536) for b in balls], "source string, block int, pass int, upto int")
    got = {(r.source, r.block, r["pass"]): r.shard for r in mixing.split(df, shards, 4).collect()}
    assert got == drawn_one_by_one(balls, shards, 4)


def test_many_sources_are_ranked_without_one_window_over_all(spark):
    sizes = {f"host{i:04d}": 1 + i * 37 % 101 for i in range(1500)}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = mixing.targets(df, mixing.WEIGHTS, 3)
    want = fill(sizes)
    assert {r.source: pytest.approx(r.target) for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert all("_range" in line for line in plan.splitlines() if "Window [" in line)


def test_shards_are_written_in_shuffled_order(spark, tmp_path):
    df = documents(spark, SMALL)
    mixing.in_shards(mixing.mix_sources(df, shards=3)).write.parquet(str(tmp_path / "mix"))
    rows = [
        (r.shard, r.turn, r.doc_id)
        for part in sorted((tmp_path / "mix").glob("part-*.parquet"))
        for r in spark.read.parquet(str(part)).select("shard", "turn", "doc_id").collect()
    ]
    assert [x[:2] for x in rows] == sorted(x[:2] for x in rows) and {x[0] for x in rows} == {0, 1, 2}
    inside = [d for shard, _, d in rows if shard == 0]
    assert inside != sorted(inside)
    report = {r.doc_id: sorted(zip(r.shards, r.turns)) for r in mixing.mix_report(df, shards=3).collect()}
    copies = defaultdict(list)
    for shard, turn, d in rows:
        copies[d].append((shard, turn))
    assert {d: sorted(c) for d, c in copies.items()} == {d: c for d, c in report.items() if c}


def test_the_draw_is_hypergeometric(spark):
    # 40 blocks, 10 of them of one source, half to the left: a mean of 5 and a variance of 5 * .75 * 20 / 39.
    seen = []
    balls = spark.range(40).selectExpr("if(id < 10, 'a', 'b') AS source", "cast(id AS int) AS block", "0 AS pass", "65536 AS upto").cache()
    for seed in range(25):
        seen.append(mixing.split(balls, 2, seed).filter("source = 'a' AND shard = 0").count())
    mean = sum(seen) / len(seen)
    variance = sum((x - mean) ** 2 for x in seen) / len(seen)
    assert abs(mean - 5) < 0.9 and 0.6 < variance < 4
    balls.unpersist()


def test_odd_rows_and_names(docs):
    df = with_clashes(odd(docs))
    rows = mixing.mix_report(df).collect()
    assert len(rows) == df.count()
    assert all(r.taken <= 3 * r["size"] for r in rows)
    mixed = mixing.mix_sources(df)
    assert [c for c in mixed.columns if c not in ("shard", "pass", "turn")] == [c for c in df.columns if c not in ("shard", "pass", "turn")]
    taken = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert taken.get(6, 0) % 2 == 0  # repeated rows are drawn alike


def test_empty_and_wordless_tables(docs):
    empty = docs((1, "a")).limit(0)
    assert mixing.mix_report(empty).count() == 0 and mixing.mix_sources(empty).count() == 0
    blank = mixing.mix_report(docs((1, "", "en", "a"), (2, None, "en", "b"))).collect()
    assert [(r["size"], r.source_size, r.taken) for r in blank] == [(0, 0, 0)] * 2


def test_no_python_in_the_plan(spark):
    mixed = mixing.mix_sources(documents(spark, SMALL))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
