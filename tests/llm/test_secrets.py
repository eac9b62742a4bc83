import random
import re

from helpers import docs_of, prose
from pyspark.sql import functions as F
from weirflow.llm.secrets import CANDIDATE, candidates, findings, grow, secret_report, weak_label, with_coverage, with_features


def hexes(rng, n):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    texts, want = [], {}
    for k in range(n):
        kind, value = k % 6, hexes(rng, 40)
        before, after = prose(rng, 20), prose(rng, 20)
        middle = {0: f'token = "{value}"', 1: f"password={value[:18]}", 2: f"commit {value}", 3: "4" + "".join(rng.choice("0123456789") for _ in range(15)), 4: f"https://x.example.com/static/{value}.js", 5: "plain words"}[kind]
        texts.append(f"{before} {middle} {after}")
        want[k] = kind < 2
    return texts, want


def test_candidates_equal_a_plain_scan(spark):
    texts = [*corpus(30)[0], None, "", "4111111111111111", "a1b2c3d4e5f6 a1b2c3d4e5f6", "x" * 3000 + "1", "-----BEGIN RSA PRIVATE KEY-----\nabc"]
    want = []
    for k, t in enumerate(texts):
        for n, m in enumerate(re.finditer(CANDIDATE, t or "")):
            want.append((k, n, m[0], t[: m.start()], t[m.end() :]))
    got = sorted((r.id, r.ordinal, r.candidate, r.before, r.after) for r in candidates(docs_of(spark, texts)).collect())
    assert [g[:3] for g in got] == [w[:3] for w in want]
    # What is kept of the sides ends at the neighbouring candidates.
    assert all(w[3].endswith(g[3]) and w[4].startswith(g[4]) and len(g[3]) <= 64 for g, w in zip(got, want))


def test_false_positives_go_and_secrets_stay(spark):
    texts, want = corpus()
    rows = findings(docs_of(spark, texts)).collect()
    by_doc = {}
    for r in rows:
        by_doc[r.doc_id] = by_doc.get(r.doc_id, False) or r.is_secret
    wrong = [k for k, y in want.items() if by_doc.get(k, False) != y]
    assert len(wrong) <= 2, wrong
    assert all(0 <= r.score <= 1 for r in rows)


def test_judged_findings_decide(spark):
    texts, _ = corpus(120)
    docs = docs_of(spark, texts)
    upside = spark.createDataFrame([(k, 0, int(k % 6 == 3)) for k in range(120) if k % 6 != 5], "id long, ordinal int, label int")
    rows = findings(docs, labelled=upside).collect()
    assert sum(r.is_secret == (r.doc_id % 6 == 3) for r in rows) >= len(rows) - 3


def test_features(spark):
    docs = docs_of(spark, ['say Token: "abcDEF123456+/" done', "see /path/to/riverriver12345.txt", "river river river"])
    found = with_features(with_coverage(candidates(docs))).orderBy("id").collect()
    one, two = found
    assert one.quoted == 1 and one.sensitive == 1 and one.path == 0 and abs(one.transitions - 3 / 14) < 1e-9 and abs(one.digits - 6 / 14) < 1e-9
    assert two.path == 1 and two.hex == 0


def test_no_labels_gives_one_half_and_empty_gives_none(spark):
    rows = with_features(with_coverage(candidates(docs_of(spark, ["abc123abc123abc123"]))))
    splits, leaves = grow(rows.withColumn("label", F.lit(None).cast("int")))
    assert all(not s for s in splits) and leaves[0] == {1: 0.5}
    assert findings(docs_of(spark, [])).count() == 0 and secret_report(docs_of(spark, [None, "", "words"])).count() == 0
    assert rows.select(weak_label(rows)).count() == 1


def test_repeated_rows_and_other_columns(spark):
    docs = docs_of(spark, ["password=abcdef123456abcd"] * 3, ids=[1, 1, 2]).withColumnRenamed("source", "score").withColumnRenamed("lang", "label")
    rows = secret_report(docs).collect()
    assert sorted((r.doc_id, r.ordinal, r.is_secret) for r in rows) == [(1, 0, True), (1, 0, True), (2, 0, True)]
    assert {r.n_chars for r in rows} == {16}


def test_a_path_of_many_folders_is_one_candidate(spark):
    docs = docs_of(spark, ["a/" * 100_000 + "1", "see a/b/c1d2e3f4g5h6 there", "password = hunter2024"])
    rows = {r.id: r for r in with_features(with_coverage(candidates(docs))).collect()}
    assert len(rows[0].candidate) == 200_001 and rows[0].path == rows[1].path == 1.0 and rows[2].path == 0.0
