import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgermill.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def models(spark):
    from ledgermill.plans.catalog import Models

    return Models(spark, SMALL)


@pytest.fixture
def rows(spark):
    """Build a DataFrame from SQL VALUES text: rows("a int, b string", "(1, 'x'), (2, NULL)")."""

    def make(ddl, values):
        names = ", ".join(c.split()[0] for c in ddl.split(", "))
        casts = [f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in ddl.split(", ")]
        return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})").selectExpr(*casts)

    return make


def as_set(df, *cols):
    return {tuple(r) for r in (df.select(*cols) if cols else df).collect()}


def as_list(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
