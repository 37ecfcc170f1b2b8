import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgermill.llm import decontam
from ledgermill.llm.common import documents, store
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes
from tests.llm.test_simhash import closure, slow_fingerprint


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage makes of the one before."""
    import numpy as np  # noqa: F401

    docs = documents(spark, SMALL)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, SMALL), name)
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns_of_documents(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]
    assert all(df.columns == steps[0].columns for df in steps[:-1])
    assert steps[-1].columns == [*steps[0].columns, "shard", "slot"]


def test_language_stage_keeps_texts_with_a_language(steps):
    gone = set(ids(steps[0])) - set(ids(steps[1]))
    assert len(gone) <= 0.01 * steps[0].count()


def test_near_duplicates_by_brute_force(steps):
    import numpy as np

    rows = sorted(((r.doc_id, r.text) for r in steps[1].collect()), key=lambda r: r[0])
    roots = closure(np.array([slow_fingerprint(t) for _, t in rows], np.uint64), 3)
    assert ids(steps[2]) == [rows[i][0] for i in sorted(set(roots))]


def test_no_benchmark_item_is_left_and_clean_documents_are(spark, steps):
    items = [decontam.normalise(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    held = {r.doc_id for r in steps[2].collect() if any(i in decontam.normalise(r.text) for i in items)}
    assert held and not held & set(ids(steps[3]))
    assert len(ids(steps[2])) - len(ids(steps[3])) <= len(held) + 2


def test_mix_repeats_whole_documents(steps):
    before = {r.doc_id: r.text for r in steps[3].collect()}
    rows = steps[4].groupBy("doc_id").agg(F.count("*").alias("n"), F.min("text").alias("text")).collect()
    assert all(before[r.doc_id] == r.text and r.n <= 3 for r in rows)


def test_last_stage_numbers_every_row(steps):
    slots = sorted((r.shard, r.slot) for r in steps[5].collect())
    sizes = [sum(s == k for s, _ in slots) for k in range(8)]
    assert slots == [(k, i) for k in range(8) for i in range(sizes[k])] and max(sizes) - min(sizes) <= 1
    assert steps[5].select(*steps[4].columns).exceptAll(steps[4]).count() == 0


def test_run_is_the_stages_in_a_row(spark, steps):
    key = lambda df: sorted((r.doc_id, r.shard, r.slot) for r in df.select("doc_id", "shard", "slot").collect())
    assert key(corpus_pipeline.run(spark, SMALL)) == key(steps[5])


def test_every_stage_takes_odd_and_empty_tables(spark, docs):
    for table in (odd(docs), docs((1, "a")).limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, table, SMALL).collect()


def test_stages_take_columns_of_names_they_use(spark, docs):
    df = with_clashes(odd(docs))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SMALL)
        assert [c for c in out.columns if c not in ("shard", "slot")] == [c for c in df.columns if c not in ("shard", "slot")], name
        out.collect()


def test_mix_is_written_shard_after_shard(spark, steps):
    plan = corpus_pipeline.mix(spark, steps[3], SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(shard" in plan and "Sort [shard" in plan


def test_no_text_with_a_language_goes_for_its_score(spark, docs, monkeypatch):
    scored = lambda df, **_: df.withColumns({"lang_pred": F.col("source"), "lang_score": F.lit(0.05)})
    monkeypatch.setattr(corpus_pipeline.lang_id, "identify_language", scored)
    df = docs((1, "kurz", "de", "de"), (2, "7", "de", corpus_pipeline.lang_id.UNKNOWN))
    assert ids(corpus_pipeline.language(spark, df, SMALL)) == [1]
