import numpy as np

from ledgermill.llm import lang_id
from ledgermill.llm.common import documents, learnable
from tests.conftest import SMALL
from tests.llm.conftest import PROSE, odd, with_clashes


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    learn = learnable("doc_id", 5, 0)
    rows = lang_id.identify_language(docs, learn=learn).select("lang", "lang_pred", "lang_score", (~learn).alias("out")).collect()
    out = [r for r in rows if r.out]
    assert len(out) > 100 and sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 < r.lang_score <= 1 for r in rows)


def test_reruns_agree_on_any_partitioning(spark):
    docs = documents(spark, SMALL)
    key = lambda d: sorted((r.doc_id, r.lang_pred, r.lang_score) for r in lang_id.identify_language(d).collect())
    assert key(docs) == key(docs.repartition(7))


def test_windows_hold_every_run_of_bytes():
    for n in (0, 1, 3, 252, 253, 254, 256, 257, 506, 1000):
        text = bytes(i % 251 + 1 for i in range(n))
        rows = lang_id.windows(text)
        assert rows.shape[1] == lang_id.WINDOW
        seen = {bytes(r[i : i + 4]) for r in rows for i in range(lang_id.WINDOW - 3)}
        assert {text[i : i + 4] for i in range(n - 3)} <= seen


def test_gradients_against_finite_differences():
    model = lang_id.ByteCnn.fresh(["a", "b", "c"], 1)
    rng = np.random.default_rng(0)
    rows, target = rng.integers(1, 255, (64, lang_id.WINDOW)).astype(np.uint8), rng.integers(0, 3, 64)

    def loss():
        return -np.log(lang_id.softmax(model.logits(rows).astype(float))[np.arange(64), target]).mean()

    before = loss()
    start = model.head.copy()
    model.fit(rows, target, 1, 0, rate=1e-3)
    assert loss() < before
    step = np.sign(start - model.head)  # one Adam step moves by the rate along the gradient's sign
    model.head = start
    for i, j in ((0, 0), (5, 1), (11, 2)):
        model.head = start.copy()
        model.head[i, j] += 1e-2
        up = loss()
        model.head[i, j] -= 2e-2
        assert step[i, j] == 0 or abs(up - loss()) < 1e-4 or np.sign(up - loss()) == step[i, j]


def test_odd_rows_and_names(docs):
    rows = [(100 + i, " ".join(PROSE[k].split()[i % 9 :] * 3), k, "s") for i in range(40) for k in PROSE]
    df = with_clashes(odd(docs).unionByName(docs(*rows)), "lang_pred", "lang_score")
    got = lang_id.identify_language(df)
    assert got.columns == [*df.columns, "lang_pred", "lang_score"]
    by = {(r.doc_id, r.text): (r.lang_pred, r.lang_score) for r in got.collect()}
    assert got.count() == df.count()
    for odd_row in ((1, None), (2, ""), (3, " \t\n "), (7, "×××\n\n---\n12 34"), (None, None)):
        assert by[odd_row] == ("und", 0.0)
    assert by[6, "same text here"][0] in PROSE


def test_nothing_to_learn_from(docs):
    rows = lang_id.identify_language(docs((1, "some text"), (2, None))).collect()
    assert {(r.lang_pred, r.lang_score) for r in rows} == {("und", 0.0)}
    assert lang_id.identify_language(docs((1, "a", "en")).limit(0)).count() == 0


def test_one_label(docs):
    rows = lang_id.identify_language(docs((1, "some text", "en"), (2, "other text"))).collect()
    assert {(r.lang_pred, r.lang_score) for r in rows} == {("en", 1.0)}


def slow_scores(model, text):
    """Label chances of a text: every filter at every position of every window, one at a time."""
    step, widest = lang_id.WINDOW - max(lang_id.WIDTHS) + 1, max(lang_id.WIDTHS)
    n = max(1, -(-(len(text) - widest + 1) // step))
    total = np.zeros(len(model.labels))
    for k in range(n):
        seen = [*text[k * step : k * step + lang_id.WINDOW]]
        seen += [0] * (lang_id.WINDOW - len(seen))
        hidden = np.zeros(model.filters.shape[1])
        for f in range(len(hidden)):
            width = lang_id.WIDTHS[f // lang_id.FILTERS]
            weights = model.filters[: width * lang_id.DIM, f].reshape(width, lang_id.DIM)
            best = max(
                sum(float(model.embed[seen[at + j]] @ weights[j]) for j in range(width)) for at in range(lang_id.WINDOW - widest + 1)
            )
            hidden[f] = max(0.0, best + float(model.bias[f]))
        total += hidden @ model.head + model.head_bias
    e = np.exp(total / n - (total / n).max())
    return e / e.sum()


def test_predictions_equal_a_position_by_position_network(docs, monkeypatch):
    texts = {i: t for i, t in enumerate(["ab", "der Tag", "x" * 300, "größe und éléments " * 30, "a" * 252 + "bcd"])}
    rng = np.random.default_rng(5)
    model = lang_id.ByteCnn.fresh(["de", "en", "fr"], 3)
    model.bias[:] = rng.standard_normal(len(model.bias)) * 0.3
    model.head_bias[:] = rng.standard_normal(3) * 0.3
    monkeypatch.setattr(lang_id, "train", lambda *_: model)
    got = {r.doc_id: r for r in lang_id.identify_language(docs(*((i, t, "en") for i, t in texts.items()))).collect()}
    for i, t in texts.items():
        p = slow_scores(model, t.encode())
        assert got[i].lang_pred == model.labels[int(p.argmax())]
        assert abs(got[i].lang_score - p.max()) < 1e-4
