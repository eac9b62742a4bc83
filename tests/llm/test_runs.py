import hashlib
import random
import time
from fractions import Fraction

import pytest
from helpers import docs_of
from pyspark.sql import functions as F
from weirflow.llm.runs import automaton_runs, find_runs, kept_words, repeated_tail, run_report, runs_of, stretches, words_of


def plain_runs(words):
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if j > i and end - start >= max(24, 3 * q) and not any(all(words[k] == words[k + d] for k in range(start, end - d)) for d in range(1, q)):
                found.append((start, end - start, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_kept(words, runs):
    return [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]


def some_words(rng):
    n, stock = rng.randrange(0, 150), rng.choice([1, 2, 2, 3, 5, 50])
    words = [b"%d" % rng.randrange(stock) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(n + 1), rng.choice([1, 2, 3, 5, 8, 14, 30])
        for k in range(rng.randrange(n - a + 1)):
            words[a + k] = words[a + k % p]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng, seen = random.Random(seed), 0
    for _ in range(400):
        words = some_words(rng)
        want = plain_runs(words)
        assert runs_of(words) == want
        assert sorted((s, e - s, q) for (s, q), e in automaton_runs(words).items()) == sorted(want)
        assert kept_words(words, want) == plain_kept(words, want)
        seen += len(want)
    assert seen > 100


def test_the_prefilter_leaves_prose_and_far_copies_to_nobody():
    rng = random.Random(9)
    prose = [b"w%d" % rng.randrange(300) for _ in range(3000)]
    passage = [b"p%d" % k for k in range(60)]
    assert stretches(prose[:1000] + passage + prose[1000:2000] + passage + prose[2000:]) == []
    line = [b"l%d" % k for k in range(9)]
    (a, b), = stretches(prose[:1000] + line * 4 + prose[1000:])
    assert a <= 1000 and b >= 1036 and b - a < 120


@pytest.mark.parametrize("words", [[b"x"] * 100_000, [b"%d" % (k % 777) for k in range(100_000)], [b"%d" % (k % 33_000) for k in range(100_000)]])
def test_long_periods_and_long_texts(words):
    began, period = time.time(), len(set(words))
    assert runs_of(words) == [(0, 100_000, period)]
    assert time.time() - began < 20


def test_fibonacci_words_have_all_their_runs():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 400:
        a, b = b, b + a
    assert runs_of(b) == plain_runs(b) != []


def test_operator_returns_runs_and_collapsed_texts(spark):
    texts = ["ha " * 30 + "end", "a b c", None, "", " \n\t", "x\u00a0y " * 24, "Ha ha " * 12 + "\nHa ha"]
    got = {r.doc_id: r for r in find_runs(docs_of(spark, texts)).collect()}
    runs = {k: [tuple(x) for x in r.runs] for k, r in got.items()}
    assert runs == {0: [(0, 30, 1)], 1: [], 2: [], 3: [], 4: [], 5: [(0, 24, 1)], 6: [(0, 26, 2)]}
    assert [got[k].collapsed for k in range(7)] == ["ha end", "a b c", "", "", "", "x\u00a0y", "Ha ha"]
    assert find_runs(docs_of(spark, [])).count() == 0


def test_clashing_columns_repeated_rows_and_null_ids(spark):
    docs = docs_of(spark, ["z " * 24, "z " * 24, "q"], ids=[None, 7, 7])
    docs = docs.withColumns({c: F.lit("mine") for c in ("id", "found", "runs", "collapsed", "starts", "best", "n_runs")})
    got = sorted((repr(r.doc_id), len(r.runs), r.collapsed) for r in find_runs(docs).collect())
    assert got == [("7", 0, "q"), ("7", 1, "z"), ("None", 1, "z")]
    assert sorted(r.n_runs for r in run_report(docs).collect()) == [0, 1, 1]


def test_report_equals_a_plain_one(spark):
    import zlib

    rng = random.Random(4)
    texts = [b" ".join(some_words(rng)).decode() for _ in range(300)] + [None, ""]
    want = []
    for i, text in enumerate(texts):
        mark = zlib.crc32(str(i).encode())
        words = words_of(text or "")
        n = len(words)
        if mark % 10 == 0 and n:
            g = mark // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            assert words == words_of(repeated_tail(text, mark))
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        own = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(runs), *own, sha(listed.encode()), sha(b" ".join(plain_kept(words, runs)))))
    got = run_report(docs_of(spark, texts))
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"}
    assert sorted(map(tuple, got.collect())) == want
