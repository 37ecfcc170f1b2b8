"""Running totals, dense numbers, intervals and bitmaps against plain forms of the same."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import bitmaps, facts
from ledgermill.operators.intervals import interval_join, interval_totals
from ledgermill.operators.prefix import dense_ids, running_total
from ledgermill.plans import catalog, serving
from ledgermill.sources.fixtures import AS_OF
from tests.conftest import as_list, as_set


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_total_over_many_ranges(spark):
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS k", "cast(id % 13 - 6 AS decimal(15,2)) AS v", "id % 3 AS rest")
    got = running_total(df, [F.col("k").asc_nulls_last()], "v", "total")
    assert got.columns == ["k", "v", "rest", "total"]
    rows, total = sorted(got.collect()), Decimal(0)
    assert len(rows) == 5000
    for r in rows:
        total += r.v
        assert r.total == total
    assert "SinglePartition" not in plan(got).split("Window")[0]


def test_running_total_with_nulls_and_without_rows(rows):
    df = rows("k int, v int", "(2, 1), (NULL, 5), (1, NULL), (3, 4)")
    order = [F.col("k").asc_nulls_last()]
    assert as_set(running_total(df, order, "v", "t")) == {(1, None, 0), (2, 1, 1), (3, 4, 5), (None, 5, 10)}
    assert running_total(df.limit(0), order, "v", "t").count() == 0


def test_no_window_of_the_cash_flow_is_in_one_partition(models):
    from ledgermill.plans import statements

    for line in plan(statements.rpt_cash_flow(models.fact_journal_entries)).splitlines():
        assert "Window" not in line or "windowspecdefinition(entry_month" not in line


def test_dense_ids(spark, rows):
    ids = dense_ids(spark.range(3000).selectExpr("format_string('k%05d', id % 1000) AS k"), "k", "n")
    assert as_set(ids) == {(f"k{i:05d}", i) for i in range(1000)}
    assert as_set(dense_ids(rows("k string", "('b'), (NULL), ('a'), ('b')"), "k", "n")) == {("a", 0), ("b", 1)}


DAY = date(2001, 1, 1)


def some_intervals(rng, n):
    for i in range(n):
        a = DAY + timedelta(rng.randint(-50, 400))
        kind = rng.random()
        yield (f"s{i}", None if kind < 0.05 else a, None if kind > 0.7 else a + timedelta(rng.randint(-3, 200)), rng.randint(0, 9))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_intervals_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    spans = list(some_intervals(rng, 120))
    asked = [DAY + timedelta(rng.randint(0, 365)) for _ in range(rng.choice([1, 2, 40]))]
    points = spark.createDataFrame([(d,) for d in [*asked, None]], "day date")
    intervals = spark.createDataFrame(spans, "id string, start date, stop date, v int")
    pairs = sorted((d, i) for d in asked for i, a, b, _ in spans if a is not None and a <= d and (b is None or d < b))
    for width in (1, 7, 32, 1000):
        joined = interval_join(points, intervals, "day", "start", "stop", width)
        assert sorted(map(tuple, joined.select("day", "id").collect())) == pairs
    totals = interval_totals(points, intervals, "day", "start", "stop", n=F.lit(1), v=F.col("v"))
    value = {i: v for i, _, _, v in spans}
    want = {(d, sum(p[0] == d for p in set(pairs)), sum(value[i] for x, i in set(pairs) if x == d)) for d in set(asked)}
    assert as_set(totals) == want


def test_intervals_without_points_or_spans(spark):
    points = spark.createDataFrame([(DAY,)], "day date")
    spans = spark.createDataFrame([("a", DAY, None, 1)], "id string, start date, stop date, v int")
    assert interval_join(points.limit(0), spans, "day", "start", "stop").count() == 0
    assert interval_totals(points.limit(0), spans, "day", "start", "stop", n=F.lit(1)).count() == 0
    assert as_set(interval_totals(points, spans.limit(0), "day", "start", "stop", n=F.lit(1))) == {(DAY, 0)}


def test_no_loop_over_points_and_intervals(models):
    for name in ("subscriptions_on_days", "interval_join"):
        text = plan(catalog.QUERIES[name](models))
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_bitmaps_count_what_distinct_counts(spark):
    df = spark.range(60_000).selectExpr("id % 5 AS a", "id % 3 AS b", "CASE WHEN id % 50 > 0 THEN (id * 31) % 40000 END AS who", "id AS v")
    ids = dense_ids(df, "who", bitmaps.ID)
    rollup = bitmaps.bitmap_rollup(df, ["a", "b"], ids, "who", ["v"])
    assert rollup.filter(f"{bitmaps.PART} > 1").count() > 0  # more values than one bitmap holds
    for by in (["a", "b"], ["a"], []):
        want = df.groupBy(*by).agg(F.countDistinct("who").alias("n"), F.sum("v").alias("v"))
        assert as_list(bitmaps.roll_up(rollup, by, "n", ["v"])) == as_list(want)


def test_bitmaps_are_hashed_and_small_where_groups_are_sparse(spark):
    df = spark.range(2_000).selectExpr("id % 700 AS a", "CASE WHEN id % 50 > 0 THEN id * 97 % 1500 END AS who", "id AS v")
    rollup = bitmaps.bitmap_rollup(df, ["a"], dense_ids(df, "who", bitmaps.ID), "who", ["v"])
    # A bitmap of thousands of bytes would be sorted by its group, and would be most of what is shuffled.
    assert "SortAggregate" not in plan(rollup) and "SortAggregate" not in plan(bitmaps.roll_up(rollup, ["a"], "n", ["v"]))
    assert dict(rollup.dtypes)[bitmaps.BITS] == "bigint" and rollup.count() <= df.count()
    want = df.groupBy("a").agg(F.countDistinct("who").alias("n"), F.sum("v").alias("v"))
    assert as_list(bitmaps.roll_up(rollup, ["a"], "n", ["v"])) == as_list(want)


def test_serving_queries_read_the_bitmaps_only(models):
    text = plan(serving.revenue_by_rep_rolled(models.revenue_bitmaps))
    assert "bitmap" in text and text.count("FileScan") == 1 and "customer_id" not in text


def test_bucketed_invoices_meet_without_an_exchange(models):
    spark = models.spark
    headers, lines = catalog.bucketed_invoices(models)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = facts.fact_invoices(headers, lines, AS_OF)
        assert "Exchange" not in plan(fact) and "Bucketed: true" in plan(fact)
        assert fact.exceptAll(models.fact_invoices).count() == 0 and models.fact_invoices.exceptAll(fact).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_models_follow_a_part_that_is_rewritten_at_equal_length(spark, tmp_path):
    import os

    from ledgermill.session import fingerprint

    folder = str(tmp_path / "t.parquet")
    spark.range(10).write.parquet(folder)
    before = fingerprint(spark, folder)
    assert fingerprint(spark, folder) == before and fingerprint(spark, str(tmp_path / "none")) == ""
    part = next(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet"))
    size, top = os.path.getsize(part), os.stat(folder).st_mtime_ns
    data = bytearray(open(part, "rb").read())
    with open(part, "r+b") as f:
        f.write(data)
    os.utime(part, ns=(10**18, 10**18))
    os.utime(folder, ns=(top, top))
    assert os.path.getsize(part) == size and fingerprint(spark, folder) != before
