import random

import numpy as np
from helpers import docs_of
from weirflow.llm.langid import DIM, Ftrl, drop_unknown, fit_temperature, identify, ngram_counts, softmax, train

STEMS = {"aa": "the and with that of on tion ing", "bb": "der und nicht sch keit ung ein ß", "cc": "que de la os ción mente ñ"}


def sample(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        lang = rng.choice(list(STEMS))
        out.append((" ".join("".join(rng.choice(STEMS[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60))), lang))
    return out


def test_held_out_accuracy_and_calibration(spark):
    fit, held = sample(600, 1), sample(300, 2)
    model = train(docs_of(spark, [t for t, _ in fit], [g for _, g in fit]))
    got = [model.predict(t) for t, _ in held]
    right = [p == g for (p, _), (_, g) in zip(got, held)]
    assert sum(right) / len(right) > 0.97
    assert abs(np.mean([s for _, s in got]) - np.mean(right)) < 0.1
    assert all(0 <= s <= 1 for _, s in got)


def test_an_unused_weight_is_zero():
    model = Ftrl(2)
    model.learn(np.array([3]), np.array([1.0]), 1)
    w = model.weights(slice(None))
    assert np.count_nonzero(w) <= 4 and w.shape == (2, DIM + 1)


def test_counts_are_of_the_whole_text_whatever_its_length():
    text = "abcdefghij" * 250_000
    assert ngram_counts(text).sum() == 3 * len(text) - 3
    assert ngram_counts("").sum() == 0 and ngram_counts("a").sum() == 1


def test_temperature_softens_what_is_too_sure():
    logits = np.array([[8.0, 0.0]] * 60 + [[0.0, 8.0]] * 40)
    labels = np.array([0] * 100)
    t = fit_temperature(logits, labels)
    assert t > 5 and softmax(logits / t).shape == (100, 2)


def test_texts_without_language(spark):
    docs = docs_of(spark, [None, "", "12 %% --", "½ ²", "the and that", "x" * 300_000], ["aa", None, "aa", "bb", "aa", "bb"])
    model = train(docs_of(spark, [t for t, _ in sample(90, 5)], [g for _, g in sample(90, 5)]))
    clash = docs.withColumnRenamed("source", "score").withColumnRenamed("n_chars", "lang_pred")
    found = {r.doc_id: r for r in identify(clash, model).collect()}
    assert [found[k].lang_pred for k in range(4)] == ["und"] * 4 and [found[k].score for k in range(4)] == [0.0] * 4
    assert found[4].lang_pred == "aa" and found[5].lang_pred in STEMS


def test_nothing_to_learn_from(spark):
    docs = docs_of(spark, ["the and", None], [None, "aa"])
    model = train(docs)
    assert [r.lang_pred for r in identify(docs, model).collect()] == ["und", "und"]
    assert identify(docs_of(spark, []), model).count() == 0


def test_one_language_and_repeated_rows(spark):
    docs = docs_of(spark, ["the and"] * 5, ["aa"] * 5, ids=[1, 1, 1, 2, 2])
    assert {(r.lang_pred, r.score) for r in identify(docs, train(docs)).collect()} == {("aa", 1.0)}


def test_stage(spark):
    rows = sample(120, 7)
    docs = docs_of(spark, [t for t, _ in rows] + [None, "...", ""], [g for _, g in rows] + ["aa", None, "bb"])
    left = drop_unknown(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == list(range(120))


def test_temperature_is_the_one_that_the_labels_were_drawn_with():
    rng = np.random.default_rng(3)
    logits = rng.normal(0, 2, (20_000, 4))
    for true in (0.3, 1.0, 4.0):
        labels = np.array([rng.choice(4, p=p) for p in softmax(logits / true)])
        assert abs(np.log(fit_temperature(logits, labels) / true)) < 0.1


def test_temperature_is_inside_its_range_without_an_error():
    labels = np.arange(400) % 3
    logits = np.eye(3)[labels] * 0.4
    t = fit_temperature(logits, labels)
    confidence = softmax(logits / t).max(axis=1).mean()
    assert 1e-3 < t < 1e3 and abs(confidence - (1 - 1 / 402)) < 1e-3
    assert fit_temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_expected_calibration_error_on_rows_kept_out(spark):
    fit, held = sample(900, 5), sample(900, 6)
    model = train(docs_of(spark, [t for t, _ in fit], [g for _, g in fit]))
    got = [(*model.predict(t), g) for t, g in held]
    error = 0.0
    for low in np.arange(0, 1, 0.1):
        inside = [(s, p == g) for p, s, g in got if low < s <= low + 0.1]
        error += abs(sum(s for s, _ in inside) - sum(ok for _, ok in inside)) / len(got)
    assert error < 0.03
    assert all(model.predict(" ".join(t.split()[:2]))[0] == g for t, g in held[:200])
