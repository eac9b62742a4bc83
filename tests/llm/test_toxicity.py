import random

import numpy as np
from helpers import docs_of, prose
from weirflow.llm.toxicity import WINDOW, Network, Scorer, score, toxicity_report, train, trigrams, window_starts


def sample(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for k in range(n):
        words = prose(rng, rng.randint(5, 120)).split()
        bad = rng.random() < 0.4
        for _ in range(rng.randint(1, 3) if bad else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["zoggle", "vrunk" + rng.choice(["", "en", "ish"])]))
        texts.append(" ".join(words)), labels.append(int(bad))
    return texts, labels


def test_gradient_equals_differences():
    net = Network.fresh({"a": 1, "b": 2})
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    index = np.array([[1, 2, 3, 0], [3, 3, 1, 2]])
    gates = np.random.default_rng(1).standard_normal((2, 4, 24))
    gates[:, 0] = 0
    gates[:, 0, :8] = 30
    push = np.array([0.7, -0.4])
    value = lambda g: float(push @ net.forward(g, index)[0].astype(np.float64))
    _, trace = net.forward(gates, index, keep=True)
    d_gates, grad = net.backward(push, gates, index, trace)
    for at in [(0, 1, 3), (1, 2, 10), (0, 3, 20), (1, 1, 0)]:
        up, down = gates.copy(), gates.copy()
        up[at] += 1e-2
        down[at] -= 1e-2
        assert abs((value(up) - value(down)) / 2e-2 - d_gates[at[0], at[1] - 1, at[2]]) < 2e-3
    for name, at in (("a", (2,)), ("v", (5,)), ("uf", (1, 4)), ("ub", (2, 18))):
        kept = net.p[name][at]
        net.p[name][at] = kept + 1e-2
        up = value(gates)
        net.p[name][at] = kept - 1e-2
        down = value(gates)
        net.p[name][at] = kept
        assert abs((up - down) / 2e-2 - grad[name][at]) < 2e-3


def test_windows_cover_every_word():
    for n in (0, 1, WINDOW, WINDOW + 1, 100, 1000):
        covered = {w for s in window_starts(n) for w in range(s, min(n, s + WINDOW))}
        assert covered == set(range(n))


def test_trigrams():
    bucket, word = trigrams(["ab", "c", "日本"])
    assert word.tolist() == [0, 0, 1, 2, 2] and len(bucket) == 5


def test_scores_do_not_depend_on_neighbours_or_bounds():
    net = Network.fresh({"a": 1})
    texts = [["a", "b"] * k for k in (0, 1, 30, 200)]
    together = [x.max() for x in Scorer(net).logits(texts)]
    alone = [Scorer(net).logits([t])[0].max() for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_held_out_accuracy(spark):
    texts, labels = sample(900, 1)
    marks = spark.createDataFrame([(k, 1, y) for k, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    rows = toxicity_report(docs_of(spark, texts), marks).collect()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out]
    assert len(rows) == 900 and len(held) > 120 and sum(p == y for p, y in held) / len(held) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_odd_texts_and_missing_labels(spark):
    docs = docs_of(spark, [None, "", "?!", "word", "word", "many words " * 30_000]).withColumnRenamed("source", "score")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one_kind = spark.createDataFrame([(3, 1), (4, None)], "doc_id long, toxic int")
    for marks in (none, one_kind):
        rows = {r.doc_id: r for r in score(docs, train(docs, marks)).collect()}
        assert len(rows) == 6 and {r.score for r in rows.values()} == {0.5} and rows[0].predicted == 1
    texts, labels = sample(120, 4)
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    model = train(docs_of(spark, texts), marks)
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert got[0] == got[1] == got[2] and got[3] == got[4] and 0 <= got[5] <= 1
    assert score(docs_of(spark, []), model).count() == 0
