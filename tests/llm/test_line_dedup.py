import random

import pytest

from ledgermill.llm import line_dedup
from tests.llm.conftest import odd, with_clashes


def brute(rows, least):
    """Delete every line inside a run with enough words that stands earlier; documents in order of their keys."""
    seen, out = set(), {}
    docs = {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        lines = text.split("\n")
        docs[key] = (lines, [i for i, line in enumerate(lines) if line.split()])
    for key in sorted(docs):
        lines, full = docs[key]
        gone = set()
        for a in range(len(full)):
            run, words = [], 0
            for b in range(a, len(full)):
                run.append(lines[full[b]].strip(" \t\r\x0b\x0c"))
                words += len(run[-1].split())
                if words >= least:
                    if tuple(run) in seen:
                        gone |= set(full[a : b + 1])
                    seen.add(tuple(run))
        out[key] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return out


def cleaned(df, **options):
    return {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df, **options).collect()}


@pytest.mark.parametrize("least", [1, 4, 9])
def test_equals_brute_force_on_random_lines(docs, least):
    rng = random.Random(least)
    pool = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 5))) for _ in range(14)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 14)))) for i in range(60)]
    assert cleaned(docs(*rows), least_words=least) == brute(rows, least)


def test_a_run_goes_as_far_as_lines_agree(docs):
    shared = [f"line {i} of a passage that two texts share" for i in range(9)]
    short = ["end", "of it"]  # too few words alone, part of the run all the same
    first = "\n".join(["top", *shared, *short, "own words here"])
    second = "\n".join(["start", "", *shared, " of it", "end", *shared[:2], *short])
    got = cleaned(docs((1, first), (2, second)), least_words=20)
    assert got[1] == first
    # The second passage: ``short`` follows other lines than in the first, so it stays.
    assert got[2] == "start\n\n of it\nend\n" + "\n".join([*shared[:2], *short]) if len(" ".join(shared[:2]).split()) < 20 else got[2]


def test_a_common_short_line_stays(docs):
    rows = [(i, f"text {i} alone\nall rights reserved") for i in range(300)]
    assert cleaned(docs(*rows)) == dict(rows)


def test_one_line_below_fifty_words_goes_from_all_but_the_first(docs):
    line = " ".join(f"w{i}" for i in range(49))
    got = line_dedup.drop_repeated_lines(docs(*((i, f"{line} own {i}\n{line}") for i in range(200)))).collect()
    assert sum(r.n_deleted for r in got) == 199 and {r.doc_id for r in got if not r.n_deleted} == {0}


def test_fingerprints_are_few_and_shared_by_equal_runs(spark, docs):
    rng = random.Random(8)
    lines = [f"{rng.randrange(10**6)} {rng.randrange(10**6)}" for _ in range(400)]
    shared = lines[100:112]  # 24 words
    texts = [(1, "\n".join(lines)), (2, "\n".join(["other words here", *shared, "and some more"]))]
    found = line_dedup.forward_windows(line_dedup.line_rows(docs(*texts), "doc_id", "text"), 20).filter("enough").collect()
    picked = {(r.doc.key, r.fingerprint) for r in found if r.picked}
    assert len([r for r in found if r.picked and r.doc.key == 1]) < 391 / 3  # windows of ten lines: about two in eleven
    assert {f for d, f in picked if d == 1} & {f for d, f in picked if d == 2}
    # Every window's fingerprint is among the picked ones of its document.
    assert {(r.doc.key, r.fingerprint) for r in found} == picked


def test_a_run_around_a_line_that_first_stands_elsewhere(docs):
    # The common line is alone in the first document, and in the run that the other two share.
    run = ["first part of a run that two documents have", "common", "second part of the run that two documents have"]
    rows = [(1, "common\n" + "alone " * 30), (2, "\n".join(["own two", *run])), (3, "\n".join([*run, "own three"]))]
    got = cleaned(docs(*rows), least_words=12)
    assert got == {1: rows[0][1], 2: rows[1][1], 3: "own three"}


def test_a_passage_of_many_words_stays_in_the_first_document_only(docs):
    passage = " ".join(f"word{i}" for i in range(55))
    rows = [(i, f"own {i}\n{passage}\nend {i}") for i in range(200)]
    got = cleaned(docs(*rows))
    assert got[0] == rows[0][1] and all(got[i] == f"own {i}\nend {i}" for i in range(1, 200))


def test_later_in_the_same_document(docs):
    passage = " ".join(f"word{i}" for i in range(60))
    got = line_dedup.drop_repeated_lines(docs((1, f"{passage}\nx\n{passage}"))).collect()[0]
    assert (got.text, got.n_lines, got.n_deleted) == (f"{passage}\nx", 3, 1)


def test_odd_rows_and_names(docs):
    df = with_clashes(odd(docs))
    got = line_dedup.drop_repeated_lines(df, least_words=2)
    assert got.count() == df.count() and set(got.columns) == {*df.columns, "n_lines", "n_deleted"}
    rows = {(r.doc_id, r.text): (r.n_lines, r.n_deleted) for r in got.collect()}
    assert rows[1, None] == (0, 0) and rows[2, ""] == (1, 0) and rows[6, "same text here"] == (1, 0)
    assert rows[None, "no key at all"] == (1, 0) and rows[3, " \t\n "] == (2, 0)


def test_null_keys_come_last(docs):
    passage = " ".join(f"word{i}" for i in range(60))
    got = {r.doc_id: r.n_deleted for r in line_dedup.drop_repeated_lines(docs((None, passage), (9, passage))).collect()}
    assert got == {9: 0, None: 1}


def test_empty_table(docs):
    assert line_dedup.drop_repeated_lines(docs((1, "a")).limit(0)).count() == 0


def test_no_python_in_the_plan(docs):
    plan = line_dedup.drop_repeated_lines(docs((1, "a b"))).drop("lang")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
