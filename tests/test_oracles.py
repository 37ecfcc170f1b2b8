import pytest

import __spark_entry__ as entry
from ledgermill.plans import catalog
from tests.conftest import SMALL
from tools.compare import connect, difference


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


REFERENCE = sorted(catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert set(REFERENCE) <= set(entry.queries())
    assert set(REFERENCE) <= set(entry.oracle_sql())


def test_entry_is_lazy_and_stable(spark):
    df = entry.entry(spark)
    assert df.count() == 1360
    assert df.columns[:3] == ["entry_month", "entry_quarter", "entry_year"]


@pytest.mark.parametrize("name", REFERENCE)
def test_query_matches_its_oracle(spark, con, name):
    verdict, _, _ = difference(spark, con, SMALL, name)
    assert verdict == "ok"
