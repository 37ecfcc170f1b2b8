import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import bronze
from ledgermill.sources import keyed_tables as kt
from tests.conftest import as_list, as_set


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def numbered(spark, n, step=1):
    return spark.range(0, n, step).selectExpr("format_string('k%06d', id) AS k", "id AS v")


def test_files_are_sorted_with_their_ranges_in_the_version(spark, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(numbered(spark, 1000), path, ["k"], file_rows=100)
    _, version = kt.Versions(spark, path).latest()
    ranges = sorted((f.low, f.high, f.rows) for f in version.files)
    assert len(ranges) >= 10 and sum(r for _, _, r in ranges) == 1000
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_only_files_that_hold_a_key_are_rewritten(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(numbered(spark, 2000, 2), path, ["k"], file_rows=50)
    before = files(path)
    # Two keys of one file, one key of another, and one in the range of a third but in no file.
    batch = rows("k string, v bigint", "('k000004', 1), ('k000006', 2), ('k001000', 3), ('k001501', 4)")
    done = kt.upsert_table(spark, path, batch, ["k"], file_rows=50)
    assert done.files == len(before) and done.in_range == 3 and done.read <= 3 and done.rewritten == 2
    assert before <= files(path)  # nothing that a reader may hold open is touched
    want = bronze.upsert(numbered(spark, 2000, 2), batch, ["k"])
    assert as_list(kt.read_table(spark, path)) == as_list(want)


def test_filters_spare_files_whose_range_holds_the_key(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(numbered(spark, 20_000, 2), path, ["k"], file_rows=1000)
    absent = spark.range(1, 20_000, 400).selectExpr("format_string('k%06d', id) AS k", "id AS v")
    done = kt.upsert_table(spark, path, absent, ["k"])
    # Every file's range holds some of the 50 absent keys, few filters do.
    assert done.in_range == done.files and done.read < done.files / 2 and done.rewritten == 0 and done.added
    # Now its own file, whose range is that of the whole table, is told apart by its filter.
    one = rows("k string, v bigint", "('k000800', 7)")
    again = kt.upsert_table(spark, path, one, ["k"])
    assert again.in_range == 2 and again.read == 1 and again.rewritten == 1
    assert kt.read_table(spark, path).count() == 10_050


def test_without_filters_the_result_is_the_same(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    kt.create_table(numbered(spark, 500), path, ["k"], file_rows=50)
    monkeypatch.setattr(kt, "PAIRS", 1)
    batch = numbered(spark, 900, 7).withColumn("v", F.lit(-1).cast("long"))
    done = kt.upsert_table(spark, path, batch, ["k"])
    assert done.read == done.in_range > 1
    assert as_list(kt.read_table(spark, path)) == as_list(bronze.upsert(numbered(spark, 500), batch, ["k"]))


def test_random_batches_equal_the_plain_upsert(spark, tmp_path):
    path, held = str(tmp_path / "t"), {}
    first = [(i % 40, f"n{i % 7}", i) for i in range(0, 280, 3)]
    schema = "a int, b string, v int"
    kt.create_table(spark.createDataFrame(first, schema), path, ["a", "b"], file_rows=20)
    held = {}
    for a, b, v in first:
        held.setdefault((a, b), []).append(v)
    for k in range(4):
        batch = [((i * 17 + k) % 60, f"n{i % 9}", 1000 * k + i) for i in range(0, 40, k + 1)]
        kt.upsert_table(spark, path, spark.createDataFrame(batch, schema), ["a", "b"], file_rows=20)
        fresh = {}
        for a, b, v in batch:
            fresh.setdefault((a, b), []).append(v)
        held |= fresh
        assert as_list(kt.read_table(spark, path)) == sorted(((*key, v) for key, vs in held.items() for v in vs), key=repr)


@pytest.mark.parametrize("kind", ["int", "bigint", "date", "decimal(12,2)", "timestamp", "boolean"])
def test_keys_of_every_kind(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    key = {"date": "date_add(date '2001-01-01', int(id))", "timestamp": "timestamp_seconds(id * 1000)", "boolean": "id % 2 = 0"}.get(kind, f"cast(id - 30 AS {kind})")
    df = spark.range(2 if kind == "boolean" else 60).selectExpr(f"{key} AS k", "id AS v")
    kt.create_table(df, path, ["k"], file_rows=10)
    done = kt.upsert_table(spark, path, df.filter("v = 1").withColumn("v", F.lit(-1).cast("long")), ["k"])
    assert done.rewritten == 1
    assert as_set(kt.read_table(spark, path), "v") == {(v,) for v in range(2 if kind == "boolean" else 60) if v != 1} | {(-1,)}
    with pytest.raises(TypeError):
        kt.create_table(df.selectExpr("array(k) AS k"), str(tmp_path / "u"), ["k"])


def test_upsert_evaluates_its_batch_once(spark, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(numbered(spark, 1000), path, ["k"])
    counter = spark.sparkContext.accumulator(0)

    def count(it):
        for x in it:
            counter.add(1)
            yield x

    batch = numbered(spark, 10).coalesce(1).mapInPandas(count, "k string, v bigint")
    kt.upsert_table(spark, path, batch, ["k"])
    assert kt.read_table(spark, path).count() == 1000
    # The range exchange looks at the batch once to cut it and once to move it, and nothing else does.
    assert counter.value <= 2


def test_replayed_batch_with_null_keys(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(rows("k string, v int", "('a', 1), (NULL, 2)"), path, ["k"])
    batch = rows("k string, v int", "(NULL, 3), ('b', 4)")
    for _ in range(2):
        kt.upsert_table(spark, path, batch, ["k"], batch_id="b1")
    want = rows("k string, v int", "('a', 1), (NULL, 2), (NULL, 3), ('b', 4)")
    assert as_list(kt.read_table(spark, path)) == as_list(want)
    # Without an id rows that match nothing are added each time, as in a plain upsert.
    kt.upsert_table(spark, path, batch, ["k"])
    assert kt.read_table(spark, path).filter("k IS NULL").count() == 3


def test_failed_upsert_leaves_the_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(rows("k string, v int", "('a', 1)"), path, ["k"])
    bad = rows("k string, v int", "('a', 2)").selectExpr("k", "cast(raise_error('no') AS int) AS v")
    with pytest.raises(Exception):
        kt.upsert_table(spark, path, bad, ["k"])
    assert as_set(kt.read_table(spark, path)) == {("a", 1)} and kt.table_versions(spark, path) == [1]
    with pytest.raises(FileNotFoundError):
        kt.read_table(spark, str(tmp_path / "none"))


def test_upsert_with_order_keeps_the_newest(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(rows("k string, t int, v int", "('a', 5, 50), ('b', 1, 10), ('c', 1, 1)"), path, ["k"])
    kt.upsert_table(spark, path, rows("k string, t int, v int", "('a', 1, 1), ('b', 2, 20), ('b', 1, 99)"), ["k"], order=["t"])
    assert as_set(kt.read_table(spark, path)) == {("a", 5, 50), ("b", 2, 20), ("c", 1, 1)}


def test_empty_batches_and_tables(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    none = rows("k string, v int", "('a', 1)").limit(0)
    kt.create_table(none, path, ["k"])
    assert kt.read_table(spark, path).count() == 0
    assert kt.upsert_table(spark, path, none, ["k"]).version == 1
    kt.upsert_table(spark, path, rows("k string, v int", "('a', 1)"), ["k"])
    assert as_set(kt.read_table(spark, path)) == {("a", 1)}


def test_versions_can_be_read_until_they_are_vacuumed(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(numbered(spark, 300), path, ["k"], file_rows=50)
    for k in range(3):
        kt.upsert_table(spark, path, rows("k string, v bigint", f"('k00000{k}', {-k - 1})"), ["k"])
    assert kt.table_versions(spark, path) == [1, 2, 3, 4]
    low = [as_set(kt.read_table(spark, path, v).filter("v < 0"), "v") for v in (1, 2, 3, 4)]
    assert low == [set(), {(-1,)}, {(-1,), (-2,)}, {(-1,), (-2,), (-3,)}]
    want = as_list(kt.read_table(spark, path))
    assert kt.vacuum_table(spark, path, keep=2) == 0  # too young
    assert kt.vacuum_table(spark, path, keep=2, older_than_hours=0) > 0
    assert kt.table_versions(spark, path) == [3, 4] and as_list(kt.read_table(spark, path)) == want
    assert as_set(kt.read_table(spark, path, 3).filter("v < 0"), "v") == low[2]


def test_small_files_are_written_together(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(numbered(spark, 100), path, ["k"])
    for k in range(4):
        kt.upsert_table(spark, path, rows("k string, v bigint", f"('new{k}', {k})"), ["k"])
    want = as_list(kt.read_table(spark, path))
    assert kt.compact_table(spark, path) >= 5
    _, version = kt.Versions(spark, path).latest()
    assert len(version.files) < 5 and as_list(kt.read_table(spark, path)) == want
    assert kt.compact_table(spark, path, least_rows=1) == 0


# -- snapshot diff ----------------------------------------------------------------------


def stamp(n):
    return {"loaded": F.lit(n)}


def test_a_source_that_brings_nothing_new_writes_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    source = rows("k string, v int", "('a', 1), ('b', NULL), (NULL, 3), (NULL, 3)")
    kt.load_changes(spark, path, source, ["k"], stamp(1))
    before = files(path)
    done = kt.load_changes(spark, path, source, ["k"], stamp(2))
    assert (done.new, done.changed, done.equal, done.upserted) == (0, 0, 3, None)
    assert files(path) == before and kt.table_versions(spark, path) == [1]
    assert kt.read_table(spark, path).columns == ["k", "v", "loaded"]


def test_new_changed_and_equal_keys(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    kt.load_changes(spark, path, rows("k string, v int, w string", "('a', 1, 'x'), ('b', NULL, 'y'), ('gone', 5, 'z'), ('two', 1, 'p'), ('two', 2, 'p'), (NULL, 7, 'n')"), ["k"], stamp(1))
    source = rows(
        "k string, v int, w string",
        "('a', 1, 'x'), ('b', 0, 'y'), ('c', 3, NULL), ('two', 1, 'p'), ('two', 2, 'q'), (NULL, 7, 'n'), (NULL, 8, 'n')",
    )
    done = kt.load_changes(spark, path, source, ["k"], stamp(2))
    assert (done.new, done.changed, done.equal) == (2, 2, 2)
    assert as_list(kt.read_table(spark, path)) == as_list(
        rows(
            "k string, v int, w string, loaded int",
            "('a', 1, 'x', 1), ('b', 0, 'y', 2), ('c', 3, NULL, 2), ('gone', 5, 'z', 1), ('two', 1, 'p', 2), ('two', 2, 'q', 2), (NULL, 7, 'n', 1), (NULL, 8, 'n', 2)",
        )
    )


def test_digests_tell_columns_and_nulls_apart(rows):
    df = rows("a string, b string", "('x', NULL), (NULL, 'x'), ('', 'x'), ('x', ''), (NULL, NULL), ('', ''), ('xx', NULL)")
    assert df.select(kt.digests(["a", "b"])[0]).distinct().count() == 7
    assert df.select(kt.digests(["a", "b"])[1]).distinct().count() == 7


def test_only_files_of_changed_keys_are_read_again(spark, tmp_path):
    path = str(tmp_path / "t")
    kt.load_changes(spark, path, numbered(spark, 3000), ["k"], file_rows=100)
    source = numbered(spark, 3000).withColumn("v", F.when(F.col("k") == "k001234", -1).otherwise(F.col("v")))
    done = kt.load_changes(spark, path, source, ["k"], file_rows=100)
    assert (done.new, done.changed, done.equal) == (0, 1, 2999)
    assert done.upserted.rewritten == 1 and done.upserted.files >= 30
    with pytest.raises(ValueError):
        other = str(tmp_path / "u")
        kt.create_table(numbered(spark, 3), other, ["k"])
        kt.load_changes(spark, other, numbered(spark, 3), ["k"])


def test_dates_survive_in_the_version_file(spark, tmp_path):
    path = str(tmp_path / "t")
    kt.create_table(spark.createDataFrame([(date(2001, 1, 2), 1)], "k date, v int"), path, ["k"])
    _, version = kt.Versions(spark, path).latest()
    assert version.files[0].low == ["2001-01-02"]
