from ledgermill.operators import quality
from tests.conftest import as_set

BRONZE, SILVER, GOLD = "stg_", ("dim_", "fact_"), "rpt_"


def _count(rules, prefix):
    return sum(len(v) if isinstance(v, list) else 1 for k, v in rules.items() if k.startswith(prefix))


def test_declared_rule_counts():
    assert [_count(quality.NOT_NULL, p) for p in (BRONZE, SILVER, GOLD)] == [26, 41, 7]
    assert [_count(quality.UNIQUE, p) for p in (BRONZE, SILVER, GOLD)] == [12, 10, 0]
    assert len(quality.ACCEPTED) == 4


def test_only_the_ledger_and_its_null_month_fail(models):
    failing = as_set(quality.check_not_null(models.by_name()).filter("failures > 0"))
    idle = 11
    assert failing == {
        *{("fact_journal_entries", c, idle) for c in ("entry_id", "transaction_ref", "account_id", "account_code", "entry_date")},
        *{("rpt_pl_statement", c, 16) for c in ("entry_month", "entry_quarter", "entry_year")},
    }


def test_unique_and_accepted(rows, models):
    df = rows("k string, s string", "('a', 'PAID'), ('a', 'paid'), (NULL, NULL), (NULL, 'x')")
    assert as_set(quality.duplicate_values(df, "k")) == {("a", 2)}
    assert as_set(quality.dq_unique(df, "m", "k")) == {("m", "k", 1)}
    assert as_set(quality.dq_accepted_values(df, "m", "s", ["PAID"])) == {("m", "s", "paid", 1), ("m", "s", "x", 1)}
    assert quality.check_unique(models.by_name()).filter("failures > 0").count() == 0
    assert quality.check_accepted_values(models.by_name()).count() == 0


def test_orphans(rows):
    child = rows("id string, fk string", "('1', 'a'), ('2', 'z'), ('3', NULL)")
    parent = rows("k string", "('a'), ('a')")
    assert as_set(quality.dq_orphans(child, "fk", parent, "k"), "id") == {("2",)}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_are_counted_while_a_model_is_stored(spark, rows, tmp_path):
    df = rows("payroll_id string, employee_id string, pay_type string", "('p', 'e', 'SALARY'), (NULL, 'e', 'x'), (NULL, NULL, NULL)")
    watched, found = quality.watch(df, "fact_payroll")
    watched.write.parquet(str(tmp_path / "t"))
    assert found() == quality.Watch("fact_payroll", {"payroll_id": 2, "employee_id": 1}, {"pay_type": 1})
    # A model without rules is left alone, and one that is empty finds nothing.
    assert quality.watch(df, "rpt_mrr")[0] is df
    empty, found = quality.watch(df.limit(0), "fact_payroll")
    empty.write.parquet(str(tmp_path / "u"))
    assert found().nulls == {"payroll_id": 0, "employee_id": 0}


def test_checks_of_stored_models_read_none_of_them(models):
    watched = quality.watched_not_null(models.spark, models.watched(list(quality.NOT_NULL)))
    assert "FileScan" not in _plan(watched)
    assert as_set(watched) == as_set(quality.check_not_null(models.by_name()))
    listed = models.watched(["fact_payroll", "fact_vendor_bills", "rpt_pl_statement"])
    assert quality.watched_accepted_values(models.by_name(), listed) is None
    listed["fact_vendor_bills"].unaccepted["status"] = 1
    assert _plan(quality.watched_accepted_values(models.by_name(), listed)).count("FileScan") == 1
    listed["fact_vendor_bills"].unaccepted["status"] = 0


def test_unique_and_orphans_scan_every_model_once(models):
    unique, orphans = _plan(quality.check_unique(models.by_name())), _plan(quality.check_orphans(models.staged()))
    assert unique.count("FileScan") == len(quality.UNIQUE) and unique.count("Exchange") == 2
    tables = {t for child, _, parent, _ in quality.FOREIGN_KEYS for t in (child, parent)}
    assert orphans.count("FileScan") == len(tables) and orphans.count("Exchange") == 2


def test_orphans_of_all_rules_at_once(rows):
    models = {
        "stg_employees": rows("employee_id string, manager_id string", "('e1', NULL), ('e2', 'e1'), ('e3', 'gone'), ('e4', 'gone')"),
        "stg_payroll": rows("payroll_id string, employee_id string", "('p1', 'e1'), ('p2', 'e9'), ('p3', NULL)"),
        "stg_payments": rows("payment_id string, invoice_id string, customer_id string", "('x', 'i', 'c')"),
    }
    assert as_set(quality.check_orphans(models)) == {
        ("stg_employees", "manager_id", "stg_employees", 2),
        ("stg_payroll", "employee_id", "stg_employees", 1),
    }
    none = {k: v.limit(0) for k, v in models.items()}
    assert {r[3] for r in as_set(quality.check_orphans(none))} == {0} and as_set(quality.check_unique(none), "failures") == {(0,)}
