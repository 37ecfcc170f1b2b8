import itertools
import random
import re
from collections import Counter

import pytest

from ledgermill.llm import filter_audit, queries
from ledgermill.llm.queries import ORACLE_SQL
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes
from tools.compare import connect, difference


def slow_audit(filters, cells):
    """Every order applied to every mask, one document kind after another."""
    removed, rows = Counter(), []
    bit = {f: 1 << i for i, f in enumerate(filters)}
    for order in itertools.permutations(filters):
        left = dict(cells)
        for step, f in enumerate(order, 1):
            gone = {m: w for m, w in left.items() if m & bit[f]}
            left = {m: w for m, w in left.items() if not m & bit[f]}

            def total(part, k):
                return sum(w[k] for w in part.values())

            fails = sum(w[0] for m, w in cells.items() if m & bit[f])
            removed[f] += total(gone, 0)
            rows.append(["".join(order), step, total(left, 0), total(gone, 0), fails - total(gone, 0), cells.get(bit[f], (0,))[0], total(gone, 1), total(gone, 2), f])
    return sorted((*r[:-1], removed[r[-1]]) for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_swaps_reach_every_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for k in filter_audit.plain_changes(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert seen == set(itertools.permutations(range(n)))


def test_random_masks_in_all_orders():
    rng = random.Random(4)
    for full in (0, 1, 3, 12, 32):
        cells = {m: (rng.randint(1, 9), rng.randint(0, 1), rng.randint(0, 3)) for m in rng.sample(range(32), full)}
        assert sorted(filter_audit.audit("ABCDE", cells)) == slow_audit("ABCDE", cells)


def test_equal_states_are_one_node():
    diagram = filter_audit.Diagram("ABCDE", {0: (5, 0, 0)})
    assert [len(level) for level in diagram.levels] == [1, 2, 2, 2, 2]
    assert diagram.root.weight == (5, 0, 0)
    before = diagram.levels[1]
    diagram.swap(2)
    assert diagram.levels[1] is before and diagram.order == list("ABDCE")


TEXTS = ["", " ", "a", "A", "Aa", "é" * 9 + "A", "é" * 10 + "A", "x # y", "a|b", "w " * 100, " ".join(f"w{i}" for i in range(100)),
         " ".join(f"w{i % 80}" for i in range(100)), " ".join(f"w{i % 79}" for i in range(100)), "W\x0bW\x1cW"]


@pytest.mark.parametrize("text", TEXTS)
def test_failures_of_one_text(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    want = (len(words) < 100) + 2 * (100 * len(set(words)) < 80 * len(words))
    want += 4 * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text))
    assert filter_audit.failures(text.encode()) == want


def slow_masks(rows, labels):
    first = {}
    for r in rows:
        if r.doc_id is not None:
            first[r.text or ""] = min(r.doc_id, first.get(r.text or "", r.doc_id))
    parts = {}
    for r in rows:
        text = r.text or ""
        mask = filter_audit.failures(text.encode()) + 16 * (r.doc_id is not None and r.doc_id > first[text])
        good, toxic = labels.get(r.doc_id, (0, 0)) if r.doc_id is not None else (0, 0)
        cell = parts.setdefault(r.lang or "", {}).setdefault(mask, [0, 0, 0])
        for k, v in enumerate((1, good, toxic)):
            cell[k] += v
    return parts


def same(df, labels, found):
    parts = slow_masks(df.collect(), labels)
    want = sorted((part, *r) for part, cells in parts.items() for r in slow_audit("ABCDE", {m: tuple(w) for m, w in cells.items()}))
    assert sorted(map(tuple, found.collect())) == want


def test_copies_labels_and_odd_rows(docs, spark):
    rows = [(i, f"text {i % 7} " + "# " * (i % 2), ("en", "de", "", None)[i % 4]) for i in range(60)]
    df = with_clashes(odd(docs).unionByName(docs(*rows)).withColumnRenamed("n_chars", "mask"), "mask")
    labels = spark.createDataFrame([(1, 1, 1), (6, 1, 0), (6, 0, 1), (11, None, 1), (12, 1, None), (None, 1, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    held = {1: (1, 1), 6: (1, 1), 11: (0, 1), 12: (1, 0)}
    found = filter_audit.audit_filters(df, with_clashes(labels, "doc_id"))
    assert found.columns == ["part", *(c.split()[0] for c in filter_audit.STEPS.split(", "))]
    same(df, held, found)


def test_very_long_texts(docs, spark):
    df = docs((1, "A" * 2_000_000), (2, "w x\n" * 300_000), (3, "A" * 2_000_000))
    same(df, {}, filter_audit.audit_filters(df, spark.createDataFrame([], "doc_id long, quality int, toxic int")))


def test_documents_match_the_statement(spark):
    assert "op13_filter_audit" in ORACLE_SQL
    assert difference(spark, connect(SMALL), SMALL, "op13_filter_audit")[0] == "ok"
    found = queries.op13_filter_audit(spark, SMALL)
    assert found.count() == 600 * found.select("part").distinct().count()


def test_empty_table(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(docs((1, "a")).limit(0), labels).count() == 0
