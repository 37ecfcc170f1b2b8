import pytest
from pyspark.sql import functions as F

from ledgermill.schemas import RAW_TABLES, raw_schema
from ledgermill.session import scratch_path, shared_dir
from ledgermill.sources import raw, sinks
from tests.conftest import as_list, as_set


@pytest.mark.parametrize("table", RAW_TABLES)
def test_csv_round_trip_keeps_every_value(spark, models, tmp_path, table):
    df = models.stg(table).select(*raw_schema(table).names)
    path = str(tmp_path / f"{table}.csv")
    sinks.write_csv(df, path)
    back = raw.read_raw_csv(spark, path, table)
    assert back.schema.simpleString() == raw_schema(table).simpleString()
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_declared_read_keeps_na_and_inferred_read_drops_it(spark, tmp_path):
    path = tmp_path / "raw_customers.csv"
    path.write_text(
        "customer_id,company_name,industry,segment,region,billing_email,credit_limit,created_at,is_active\n"
        "C1, Acme ,N/A,SMB,,a@b.c,10000,2001-01-02,True\n"
        "C2,None,n/a,SMB,West,a@b.c,2500.50,2001-01-03,False\n"
    )
    declared = raw.read_raw_csv(spark, str(path), "raw_customers")
    assert as_set(declared, "customer_id", "company_name", "industry", "region", "is_active") == {
        ("C1", " Acme ", "N/A", None, True),
        ("C2", "None", "n/a", "West", False),
    }
    inferred = raw.read_raw_csv_inferred(spark, str(path))
    assert as_set(inferred, "customer_id", "company_name", "industry", "region", "credit_limit") == {
        ("C1", " Acme ", None, None, 10000.0),
        ("C2", None, None, "West", 2500.5),
    }


def test_columns_are_bound_by_name(spark, tmp_path):
    path = tmp_path / "raw_products.csv"
    path.write_text(
        "created_at,product_name,product_id,unit_price,product_category,description,is_active\n2001-01-02,Seat,P1,9.50,Subscription,x,true\n"
    )
    got = raw.read_raw_csv(spark, str(path), "raw_products")
    assert got.columns == raw_schema("raw_products").names
    assert as_set(got, "product_id", "product_name", "product_category") == {("P1", "Seat", "Subscription")}
    for text in ("product_id\nP1\n", path.read_text().replace("description", "colour")):
        path.write_text(text)
        with pytest.raises(ValueError):
            raw.read_raw_csv(spark, str(path), "raw_products")


def test_both_forms_of_the_employee_file(spark, tmp_path):
    path = tmp_path / "raw_employees.csv"
    head = "employee_id,first_name,last_name,department,{}role,salary,hire_date,is_active,created_at,manager_id\n"
    row = "E1,Ann,Lee,Engineering,{}Lead,100,2001-01-02,true,2001-01-02,\n"
    path.write_text(head.format("cost_center,salary_account,") + row.format("COGS,5300,"))
    assert as_set(raw.read_raw_csv(spark, str(path), "raw_employees"), "role", "cost_center", "salary_account") == {("Lead", "COGS", "5300")}
    path.write_text(head.format("") + row.format(""))
    assert as_set(raw.read_raw_csv(spark, str(path), "raw_employees"), "role", "cost_center", "salary_account") == {("Lead", None, None)}


def test_folder_becomes_stored_tables(spark, tmp_path):
    for name in ("aisles", "orders"):
        (tmp_path / f"{name}.csv").write_text("id,v\n1,a\n2,b\n")
    for _ in range(2):
        got = raw.load_csv_dir(spark, str(tmp_path), "folder", scratch_path(spark, "folder"), skip=("orders",))
    assert list(got) == ["aisles"] and raw.source(spark, "folder", "aisles").count() == 2


def test_malformed_declared_csv_fails(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("account_id,account_code,account_name,account_type,account_subtype,is_active\nA1,1010,Cash,Asset,x,maybe\n")
    with pytest.raises(Exception):
        raw.read_raw_csv(spark, str(path), "raw_chart_of_accounts").collect()


ODD = ['Acme "The Best" Ltd', '"quoted"', '"', '""', "a, b", "back\\slash", "ends\\", "two\nlines", "cr\r\nlf", '\\"', " blanks ", "", None, "'", '",\n"']


def test_odd_texts_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(f"P{i}", t, None, None, t, True, None) for i, t in enumerate(ODD)], raw_schema("raw_products"))
    path = str(tmp_path / "raw_products.csv")
    sinks.write_csv(df, path)
    assert as_list(raw.read_raw_csv(spark, path, "raw_products", multi_line=True)) == as_list(df)
    assert as_list(raw.read_raw_csv(spark, path, "raw_products", multi_line=None)) == as_list(df)
    inferred = raw.read_raw_csv_inferred(spark, path)
    assert as_list(inferred, "product_id", "product_name") == sorted(((f"P{i}", t or None) for i, t in enumerate(ODD)), key=repr)


def test_files_of_other_programs(spark, tmp_path):
    import csv

    path = tmp_path / "raw_products.csv"
    with open(path, "w", newline="") as f:
        writer = csv.writer(f, lineterminator="\n")
        writer.writerow(raw_schema("raw_products").names)
        writer.writerows([f"P{i}", t, "x", "9.50", "d", "True", "2001-01-02"] for i, t in enumerate(ODD) if t)
    want = sorted((f"P{i}", t) for i, t in enumerate(ODD) if t)
    for multi_line in (True, None):
        assert as_list(raw.read_raw_csv(spark, str(path), "raw_products", multi_line), "product_id", "product_name") == want
    assert as_list(raw.read_raw_csv_inferred(spark, str(path)), "product_id", "product_name") == want
    # Written here, read there.
    out = str(tmp_path / "out")
    sinks.write_csv(raw.read_raw_csv(spark, str(path), "raw_products", True).coalesce(1), out)
    part = next(p for p in (tmp_path / "out").iterdir() if p.suffix == ".csv")
    with open(part, newline="") as f:
        assert sorted((r["product_id"], r["product_name"]) for r in csv.DictReader(f)) == want


@pytest.mark.parametrize("text", ['id,v\n1,"a\nb"\n2,c\n', 'v,id\n"a\nb",1\nc,2\n', 'id,v,w\n1,"a\nb",x\n'])
def test_line_breaks_in_quotes_are_read_or_refused(spark, tmp_path, text):
    path = tmp_path / "x.csv"
    path.write_text(text)
    assert raw.has_line_breaks(spark, str(path))
    assert as_set(raw.read_raw_csv_inferred(spark, str(path)), "v") >= {("a\nb",)}
    for action in (lambda df: df.collect(), lambda df: df.count()):
        with pytest.raises(Exception):
            action(raw.read_raw_csv_inferred(spark, str(path), multi_line=False))


def test_lines_that_end_in_cr_lf(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes(b'id,v\r\n1,"a\r\nb"\r\n2,"say ""hi"""\r\n')
    # The reader takes the file's line end for a line feed inside quotes too.
    assert as_set(raw.read_raw_csv_inferred(spark, str(path))) == {(1, "a\nb"), (2, 'say "hi"')}


def test_empty_text_is_not_null_where_it_is_quoted(spark, tmp_path):
    path = tmp_path / "raw_products.csv"
    path.write_text(",".join(raw_schema("raw_products").names) + '\nP1,"",,,"x",true,\n')
    assert as_set(raw.read_raw_csv(spark, str(path), "raw_products"), "product_name", "product_category") == {("", None)}


def test_csv_folder(spark, tmp_path):
    for name in ("aisles", "departments", "orders"):
        (tmp_path / f"{name}.csv").write_text("id,v\n1,a\n2,N/A\n")
    (tmp_path / "notes.txt").write_text("no")
    got = raw.read_csv_dir(spark, str(tmp_path), skip=("orders",))
    assert sorted(got) == ["aisles", "departments"]
    assert as_set(got["aisles"]) == {(1, "a"), (2, None)}


def test_load_replace_and_counts(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    df = spark.range(100).selectExpr("id", "cast(2000 + id % 3 AS int) AS y")
    sinks.load_replace(df, "loads.t", partition_by="y")
    sinks.load_replace(df.filter("id < 40"), "loads.t", partition_by="y")
    assert raw.source(spark, "loads", "t").count() == 40
    assert as_list(raw.ref(spark, "t", "loads").filter("y = 2001").agg(F.count("*"))) == [(13,)]
    plan = raw.source(spark, "loads", "t").filter("y = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan
    assert as_set(sinks.load_counts({"a": df, "b": df.limit(0)})) == {("a", 100), ("b", 0)}


def test_readers_see_the_old_rows_or_the_new_ones(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    root = str(tmp_path / "u")
    assert sinks.load_replace(spark.range(10), "loads.u", path=root) == 1
    began = spark.table("loads.u")  # resolved before the swap
    assert sinks.load_replace(spark.range(20), "loads.u", path=root) == 2
    assert began.count() == 10 and spark.table("loads.u").count() == 20
    bad = spark.range(5).selectExpr("cast(raise_error('no') AS bigint) AS id")
    with pytest.raises(Exception):
        sinks.load_replace(bad, "loads.u", path=root)
    assert spark.table("loads.u").count() == 20 and sinks.current_version(spark, "loads.u") == 2
    # A load that fails before the swap is not shown, and the next one takes another number or its place.
    assert sinks.load_replace(spark.range(30), "loads.u", path=root) > 2
    assert spark.table("loads.u").count() == 30


def test_loads_are_kept_shown_again_and_dropped(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    root = tmp_path / "w"
    for n in (1, 2, 3, 4):
        sinks.load_replace(spark.range(n), "loads.w", path=str(root), keep=3)
    assert sinks.table_versions(spark, "loads.w") == [2, 3, 4] and len(list(root.iterdir())) == 3
    assert [sinks.read_version(spark, "loads.w", n).count() for n in (2, 3, 4)] == [2, 3, 4]
    sinks.show_version(spark, "loads.w", 3)
    assert spark.table("loads.w").count() == 3
    assert sinks.drop_versions(spark, "loads.w", keep=1) == [2]  # 4 is newer than the one shown and stays
    assert sinks.load_replace(spark.range(5), "loads.w", path=str(root), keep=1) == 5
    assert sinks.table_versions(spark, "loads.w") == [5] and spark.table("loads.w").count() == 5


def test_a_plain_table_becomes_the_first_load(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    spark.range(7).write.saveAsTable("loads.plain")
    sinks.load_replace(spark.range(8), "loads.plain")
    assert spark.table("loads.plain").count() == 8 and sinks.read_version(spark, "loads.plain", 0).count() == 7


def test_buckets_join_without_an_exchange(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    left = spark.range(1000).selectExpr("id AS k", "id AS a")
    right = spark.range(0, 3000, 2).selectExpr("id % 1500 AS k", "id AS b")
    for name, df in (("left", left), ("right", right)):
        sinks.load_replace(df, f"loads.b_{name}", bucket_by=["k"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("loads.b_left").join(spark.table("loads.b_right"), "k", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert as_list(joined) == as_list(left.join(right, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_without_a_shared_folder_a_cluster_is_refused():
    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(Session(master))
    assert shared_dir(Session("local[2]"))


def test_settings_that_the_session_chose_stay(spark):
    from ledgermill.session import tune

    key, before = "spark.sql.adaptive.forceOptimizeSkewedJoin", spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin")
    spark.conf.set(key, "false")
    assert tune(spark).conf.get(key) == "false"
    spark.conf.set(key, before)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
