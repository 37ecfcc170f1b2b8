import random
import zlib

import numpy as np
import pytest

from ledgermill.llm import decontam
from ledgermill.llm.common import documents
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes


def edits(pattern, text):
    """Least edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def spoil(text, n, rng):
    s = list(text)
    for _ in range(n):
        j = rng.randrange(len(s))
        kind = rng.randrange(3)
        if kind == 0:
            s[j] = rng.choice("abcéß ")
        elif kind == 1:
            del s[j]
        else:
            s.insert(j, rng.choice("xyzü"))
    return "".join(s)


@pytest.fixture(scope="module")
def items(spark):
    rows = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").limit(5).collect()
    return [(r.item_id, decontam.normalise(r.text)) for r in rows]


def test_regions_are_those_that_brute_force_finds(items, spark):
    rng = random.Random(3)
    prose = [decontam.normalise(r.text) for r in documents(spark, SMALL).limit(60).collect()]
    index = decontam.Index(items, 0.1)
    docs = []
    for k in range(40):
        text = rng.choice(items)[1]
        around = (prose[k][: rng.randrange(150)], prose[k + 1][: rng.randrange(150)])
        docs.append(decontam.normalise(f"{around[0]} {spoil(text, rng.randrange(1 + len(text) // 8), rng)} {around[1]}"))
    got = {(d, i): e for d, i, e, _, _ in decontam.matches(index, docs)}
    want = {}
    for d, text in enumerate(docs):
        for i, (_, pattern) in enumerate(items):
            e = edits(pattern, text)
            if e <= index.budget[i]:
                want[d, i] = e
    assert got == want and 10 < len(want) < 40 + 5


def test_the_region_reported_has_the_distance_reported(items):
    rng = random.Random(5)
    index = decontam.Index(items, 0.1)
    docs = ["before it " + spoil(t, 6, rng) + " and after" for _, t in items]
    for d, i, e, start, end in decontam.matches(index, docs):
        region = docs[d][start:end]
        full = np.arange(len(region) + 1)
        for a, c in enumerate(items[i][1], 1):
            new = [a]
            for b, x in enumerate(region, 1):
                new.append(min(full[b - 1] + (c != x), full[b] + 1, new[b - 1] + 1))
            full = new
        assert full[-1] == e


def flagged(df):
    return {r.doc_id: sorted(m.item for m in r.matches) for r in df.collect() if r.matches}


def test_query_finds_every_whole_item(spark):
    docs, benchmark = documents(spark, SMALL), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [(r.item_id, decontam.normalise(r.text)) for r in benchmark.collect()]
    exact = {}
    for r in docs.collect():
        held = sorted(i for i, t in items if t in decontam.normalise(r.text))
        if held:
            exact[r.doc_id] = held
    assert exact
    got = flagged(decontam.contamination(docs, benchmark))
    assert all(set(held) <= set(got.get(d, [])) for d, held in exact.items())
    clean = {r.doc_id for r in decontam.decontaminate(docs, benchmark).select("doc_id").collect()}
    assert clean == {r.doc_id for r in docs.collect()} - set(got)


def test_several_passes_give_the_same(spark):
    docs, benchmark = documents(spark, SMALL), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    once = flagged(decontam.contamination(docs, benchmark))
    assert once == flagged(decontam.contamination(docs, benchmark, chunk_chars=2000))
    assert once == flagged(decontam.contamination(docs, benchmark, chunk_chars=2000, held_chars=5000))


def test_what_workers_hold_is_bounded(spark, docs, monkeypatch):
    items = [f"ship {zlib.crc32(b'%d' % n)} of {zlib.crc32(b'x%d' % n)} tons" for n in range(60)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = docs((1, items[0]), (2, "x " + items[59] + " y"), (3, items[7] + " and " + items[33]), (4, None), (5, "nothing of it"))
    passes, whole = [], decontam.scan

    def counted(docs, parts, text, mark):
        passes.append(sum(len(i[1]) for p in parts for own in p.value for i in own.items))
        return whole(docs, parts, text, mark)

    monkeypatch.setattr(decontam, "scan", counted)
    got = flagged(decontam.contamination(df, benchmark, chunk_chars=150, held_chars=600))
    assert {d: set(i) for d, i in got.items()} == {1: {0}, 2: {59}, 3: {7, 33}}
    assert len(passes) > 3 and max(passes) <= 600 and sum(passes) == sum(map(len, items))


def test_case_space_and_long_items(spark, docs):
    passage = "It was the Best of times, it was\n the worst of  TIMES, it was the age of wisdom and of much else"
    words = " ".join(f"w{i * i % 1013}" for i in range(900))
    benchmark = spark.createDataFrame([(1, passage), (2, words), (3, "too short"), (None, passage), (4, None)], "item_id long, text string")
    df = docs((1, "x " + passage.upper().replace("\n", " ") + " y"), (2, "a " + words[1500:3200] + " b"), (3, "too short"), (4, "It was the best of books"))
    # A part of a long item is not the item, and a short one is sought like any other.
    assert {d: set(i) for d, i in flagged(decontam.contamination(df, benchmark)).items()} == {1: {1}, 3: {3}}


def test_odd_rows_and_names(spark, docs):
    benchmark = spark.createDataFrame([(1, "word17 runs on word18 runs on word19 runs on word20")], "item_id long, text string")
    df = with_clashes(odd(docs), "matches")
    got = decontam.contamination(df, benchmark)
    assert got.count() == df.count() and set(flagged(got)) == {4}
    assert decontam.decontaminate(with_clashes(odd(docs)), benchmark).count() == df.count() - 1


def test_empty_tables(spark, docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    df = docs((1, "a"), (2, None))
    assert decontam.decontaminate(df, nothing).count() == 2
    assert decontam.contamination(df.limit(0), spark.createDataFrame([(1, "x" * 50)], "item_id long, text string")).count() == 0


def test_one_document_holds_many_items_and_copies_agree(spark, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    text = " and ".join(t for _, t in items)
    got = flagged(decontam.contamination(docs((1, text), (2, text), (2, text)), benchmark))
    assert got == {1: [i for i, _ in items], 2: [i for i, _ in items]}


def test_short_items_by_brute_force():
    rng = random.Random(9)
    letters = "abcdé ß"
    items = []
    while len(items) < 60:
        t = decontam.normalise("".join(rng.choice(letters) for _ in range(1 + len(items))))
        if t:
            items.append((len(items), t))
    docs = []
    for k in range(80):
        text = rng.choice(items)[1]
        docs.append(decontam.normalise(f"zz {spoil(text, rng.randrange(2 + len(text) // 9), rng)} yy"))
    got, want = set(), set()
    for q in decontam.SHORTER:
        own = [x for x in items if decontam.gram_size(len(x[1]), 0.1) == q]
        index = decontam.Index(own, 0.1, q)
        assert index.budget.tolist() == [len(t) // 10 for _, t in own] and (index.least > 0).all()
        got |= {(d, own[i][0], e) for d, i, e, _, _ in decontam.matches(index, docs)}
    for d, text in enumerate(docs):
        for i, t in items:
            if len(t) < 10:
                at = [k for k in range(len(text)) if text.startswith(t, k)]
                ends = lambda k: 0 < k < len(text) and text[k - 1].isalnum() and text[k].isalnum()
                if any(not ends(k) and not ends(k + len(t)) for k in at):
                    want.add((d, i, 0))
            elif edits(t, text) <= len(t) // 10:
                want.add((d, i, edits(t, text)))
    assert got == want and {len(items[i][1]) for _, i, e in want if e} & {*range(10, 32)} and any(len(items[i][1]) < 8 for _, i, _ in want)


def test_query_and_pipeline_seek_items_of_every_length(spark, docs, tmp_path):
    import corpus_pipeline
    from ledgermill.llm.queries import op5_decontamination

    long = {n: decontam.normalise(" ".join(f"w{i * i % 1013}" for i in range(n)))[:n].strip() for n in (1000, 1002, 5000)}
    rows = [(1, "Who discovered penicillin?"), (2, "42"), (3, "東京"), (4, "   "), (5, "Ünit"), *long.items()]
    spark.createDataFrame(rows, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    half = long[1002][: len(long[1002]) // 2]
    texts = [
        (1, "so: who discovered\nPENICILLIN? he asked", {1}), (2, "it is 42.", {2}), (3, "it is 142 or 420", set()), (4, "私は東京に行く", {3}),
        (5, "one unit, zwei ünite", set()), (6, "eine ünit", {5}), (7, f"a {half} b", set()), (8, f"a {long[5000][:4000]} b", {1000, 1002}),
        (9, f"a {long[5000][:100]}XX{long[5000][120:]} b", {5000}), (10, "who discovered penicilin", {1}), (11, "", set()), (12, None, set()),
    ]
    df = docs(*[(i, t) for i, t, _ in texts])
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in op5_decontamination(spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, {})[r.item_id] = (r.distance, r.start, r.end)
    short = {i: want for i, _, want in texts if i not in (8, 9)}
    assert {i: set(got.get(i, {})) for i in short} == short
    assert got[9][5000][0] <= 20 and got[9][5000][2] - got[9][5000][1] > 0.99 * len(long[5000]) and 5000 not in got.get(8, {})
    clean = corpus_pipeline.decontamination(spark, df, str(tmp_path))
    assert {r.doc_id for r in clean.collect()} == {i for i, _, _ in texts} - set(got)


def test_every_item_is_sought_as_a_whole_by_default(spark, docs):
    long = " ".join(f"term{i}" for i in range(400))  # over 1,000 characters
    benchmark = spark.createDataFrame([(1, "who found it?"), (2, long), (3, " \n ")], "item_id long, text string")
    df = docs((1, "so who found it? we ask"), (2, long[: len(long) // 2]), (3, f"before {long} after"), (4, "nothing"))
    got = {r.doc_id: sorted(m.item for m in r.matches) for r in decontam.contamination(df, benchmark).collect()}
    assert got == {1: [1], 2: [], 3: [2], 4: []}


def test_very_long_texts(spark, docs):
    item = "a question of some length about rivers and the towns on them"
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    df = docs((1, "x" * 2_000_000), (2, "word " * 200_000 + item + " word" * 1000), (3, "\n" * 500_000))
    got = {r.doc_id: [m.item for m in r.matches] for r in decontam.contamination(df, benchmark).collect()}
    assert got == {1: [], 2: [7], 3: []}
