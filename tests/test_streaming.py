import os

from ledgermill.streaming import upserts
from ledgermill.streaming.upserts import read_file_stream, stream_dedupe, stream_upsert
from tests.conftest import as_list, as_set


def _write(spark, folder, name, values):
    df = spark.sql(f"SELECT id, cast(ts AS timestamp) AS ts, v FROM VALUES {values} AS t(id, ts, v)")
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}-{name}")
    os.makedirs(folder, exist_ok=True)
    part = next(f for f in os.listdir(f"{folder}-{name}") if f.endswith(".parquet"))
    os.link(f"{folder}-{name}/{part}", f"{folder}/{name}.parquet")
    return df.schema


def test_upsert_across_batches_and_restart(spark, tmp_path):
    folder, state, changes = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "changes")
    schema = _write(spark, folder, "a", "('x', '2001-01-01 00:00:00', 1), ('x', '2001-01-02 00:00:00', 2), ('y', '2001-01-01 00:00:00', 3)")

    def run():
        query = stream_upsert(read_file_stream(spark, folder, schema, files_per_batch=1), ["id"], ["ts"], state, changes)
        query.awaitTermination()
        return as_set(upserts.latest_rows(spark, state, ["id", "v"]))

    assert run() == {("x", 2), ("y", 3)}
    _write(spark, folder, "b", "('y', '2001-01-03 00:00:00', 30), ('z', '2001-01-03 00:00:00', 40)")
    assert run() == {("x", 2), ("y", 30), ("z", 40)}
    # An older event in a later batch does not replace a newer one.
    _write(spark, folder, "c", "('y', '2001-01-02 00:00:00', 31), ('z', '2001-01-01 00:00:00', 41)")
    assert run() == {("x", 2), ("y", 30), ("z", 40)}
    # A restart with nothing new must not lose the table.
    assert run() == {("x", 2), ("y", 30), ("z", 40)}
    # The table as it was, and what a batch changed.
    assert as_set(upserts.latest_rows(spark, state, ["id", "v"], batch=0)) == {("x", 2), ("y", 3)}
    assert as_set(spark.read.parquet(f"{changes}/batch=1"), "id", "v") == {("y", 30), ("z", 40)}
    assert upserts.latest_rows(spark, state, ["v", "id", "ts"]).columns == ["v", "id", "ts"]


def test_upsert_touches_the_state_of_its_own_keys_only(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    many = ", ".join(f"('k{i}', '2001-01-01 00:00:00', {i})" for i in range(500))
    schema = _write(spark, folder, "a", many)
    stream_upsert(read_file_stream(spark, folder, schema), ["id"], ["ts"], state).awaitTermination()
    _write(spark, folder, "b", "('k7', '2001-01-02 00:00:00', -7)")
    query = stream_upsert(read_file_stream(spark, folder, schema), ["id"], ["ts"], state)
    query.awaitTermination()
    operator = query.lastProgress["stateOperators"][0]
    assert operator["numRowsTotal"] == 500 and operator["numRowsUpdated"] == 1
    assert upserts.latest_rows(spark, state, ["id", "v"]).filter("v < 0").count() == 1


def test_rows_without_a_whole_key_are_all_kept(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    twice = "(cast(NULL AS string), '2001-01-01 00:00:00', 1), (NULL, '2001-01-01 00:00:00', 1), (NULL, '2001-01-01 00:00:00', 2), ('x', NULL, 3)"
    schema = _write(spark, folder, "a", twice)
    stream_upsert(read_file_stream(spark, folder, schema), ["id"], ["ts"], state).awaitTermination()
    _write(spark, folder, "b", "(cast(NULL AS string), '2001-01-01 00:00:00', 1), ('x', cast(NULL AS string), 4)")
    stream_upsert(read_file_stream(spark, folder, schema), ["id"], ["ts"], state).awaitTermination()
    assert as_list(upserts.latest_rows(spark, state, ["id", "v"])) == [("x", 4), (None, 1), (None, 1), (None, 1), (None, 2)]


def test_dedupe_drops_repeats_within_and_across_batches(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    schema = _write(spark, folder, "a", "('x', '2001-01-01 00:00:00', 1), ('x', '2001-01-01 00:05:00', 1), ('y', '2001-01-01 00:01:00', 2)")
    _write(spark, folder, "b", "('x', '2001-01-01 00:10:00', 1), ('z', '2001-01-01 00:11:00', 3)")
    stream = read_file_stream(spark, folder, schema, files_per_batch=1)
    query = stream_dedupe(stream, ["id"], "ts", "1 day", path, str(tmp_path / "state"))
    query.awaitTermination()
    got = upserts.kept_rows(spark, path, schema)
    assert got.count() == 3
    assert as_set(got, "id", "v") == {("x", 1), ("y", 2), ("z", 3)}
    assert upserts.late_rows(spark, path, schema).count() == 0


def test_late_rows_have_a_table_of_their_own(spark, tmp_path):
    folder, path, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    deliveries = [
        "('x', '2001-01-01 10:00:00', 1), ('y', '2001-01-01 12:00:00', 2), ('y', '2001-01-01 12:00:00', 2), ('z', '2001-01-01 09:00:00', 3)",
        "('w', '2001-01-01 10:59:00', 4), ('y', '2001-01-01 12:00:00', 2), ('v', '2001-01-01 11:00:00', 5), ('v', '2001-01-01 11:00:01', 6), ('u', '2001-01-01 15:00:00', 7)",
        "('t', '2001-01-01 13:59:00', 8), ('t', '2001-01-01 14:01:00', 9), (cast(NULL AS string), cast(NULL AS string), 10)",
    ]
    dropped = 0
    for k, values in enumerate(deliveries):
        schema = _write(spark, folder, f"f{k}", values)
        query = stream_dedupe(read_file_stream(spark, folder, schema), ["id"], "ts", "1 hour", path, state)
        query.awaitTermination()
        dropped += sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    late = as_set(upserts.late_rows(spark, path, schema), "id", "v", "late_by_seconds")
    assert late == {("w", 4, 60.0), ("v", 5, 0.0), ("t", 8, 60.0)}
    assert dropped == len(late)  # what the engine itself passed over
    assert as_set(upserts.kept_rows(spark, path, schema), "id", "v") == {("x", 1), ("y", 2), ("z", 3), ("v", 6), ("u", 7), ("t", 9), (None, 10)}
    totals = upserts.dedupe_counts(spark, path).agg({"input": "sum", "kept": "sum", "repeated": "sum", "late": "sum"})
    assert as_set(totals, "sum(input)", "sum(kept)", "sum(repeated)", "sum(late)") == {(12, 7, 2, 3)}


def test_late_rows_within_one_run_of_many_batches(spark, tmp_path):
    folder, path, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    for k in range(4):
        schema = _write(spark, folder, f"f{k}", f"('new{k}', '2001-01-0{2 * k + 1} 00:00:00', {k}), ('old{k}', '2001-01-01 00:00:00', {k})")
    query = stream_dedupe(read_file_stream(spark, folder, schema, files_per_batch=1), ["id"], "ts", "1 day", path, state)
    query.awaitTermination()
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert upserts.late_rows(spark, path, schema).count() == dropped > 0
    assert upserts.kept_rows(spark, path, schema).count() + dropped == 8
