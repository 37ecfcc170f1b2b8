import random

import pytest

import corpus_pipeline
from ledgermill.llm import queries
from ledgermill.llm.common import connected_components, free_name, store


def test_components_of_chains_stars_and_loops(spark):
    random.seed(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, x) for x in range(1000, 1400)]
    loose = [(random.randrange(5000, 5600), random.randrange(5000, 5600)) for _ in range(350)]
    edges = chain + star + loose + [(1, 1), (160, 100)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    rows = got.collect()
    assert {r.node: r.root for r in rows} == {x: find(x) for x in parent} and len(rows) == len(parent)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_free_name_ignores_case(spark):
    assert free_name(spark.range(1).selectExpr("id AS A", "id AS _a"), "a") == "__a"


def test_stored_rows_are_in_the_shared_folder(spark):
    df = store(spark.range(5), "x")
    assert df.count() == 5 and spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_oracle(spark, name):
    from tests.conftest import SMALL
    from tools.compare import connect, difference

    assert difference(spark, connect(SMALL), SMALL, name)[0] == "ok"
