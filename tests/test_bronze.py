from ledgermill.operators import bronze
from ledgermill.schemas import LOAD_KEYS, RAW_TABLES, raw_schema
from tests.conftest import as_list, as_set


def test_every_key_is_a_declared_column():
    for table in RAW_TABLES:
        assert set(LOAD_KEYS[table]) <= set(raw_schema(table).names)


def test_stage_projects_and_stamps(models):
    df = bronze.stage(models.raw.raw_employees, "raw_employees", "2001-08-15 00:00:00")
    assert df.columns == raw_schema("raw_employees").names + ["ingestion_timestamp"]
    accounts = bronze.stage(models.raw.raw_chart_of_accounts.selectExpr("*", "1 AS extra"), "raw_chart_of_accounts")
    assert "extra" in accounts.columns


def test_upsert_semantics(rows):
    target = rows("k string, v int", "('a', 1), ('b', 2), (NULL, 3)")
    batch = rows("k string, v int", "('b', 20), ('b', 21), ('c', 30), (NULL, 40)")
    got = bronze.upsert(target, batch, ["k"])
    # a vanished from the source and survives; b's duplicates stay; NULL keys accumulate.
    assert as_list(got) == as_list(rows("k string, v int", "('a', 1), ('b', 20), ('b', 21), ('c', 30), (NULL, 3), (NULL, 40)"))


def test_upsert_on_two_keys(rows):
    target = rows("a int, b int, v int", "(1, 1, 10), (1, 2, 20)")
    got = bronze.upsert(target, rows("a int, b int, v int", "(1, 2, 99)"), ["a", "b"])
    assert as_set(got) == {(1, 1, 10), (1, 2, 99)}


def test_dedupe_latest(rows):
    df = rows("k string, t int, v string", "('a', 1, 'x'), ('a', 3, 'y'), ('a', 3, 'z'), ('b', NULL, 'q')")
    assert as_set(bronze.dedupe_latest(df, ["k"], ["t"])) == {("a", 3, "z"), ("b", None, "q")}


def test_dedupe_latest_combines_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("'hot' AS k", "id AS t")
    plan = bronze.dedupe_latest(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
