import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from weirflow.llm import negatives
from weirflow.llm.negatives import hard_negatives, mining_report, packed, scores_of, unpacked

ROWS = "id long, label long, vector array<long>"


def plain(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    rows = sorted(set(rows))
    out = []
    for a in rows:
        if not is_anchor(a[0]):
            continue
        score = lambda r: sum(x * y for x, y in zip(a[2], r[2]))
        others = sorted((r for r in rows if len(r[2]) == len(a[2])), key=lambda r: (-score(r), r[0]))
        for p in [r for r in others if r[1] == a[1] and r != a][:positives]:
            fit = [r for r in others if r[1] != a[1] and low * score(p) <= 100 * score(r) <= high * score(p)]
            out += [(a[0], p[0], k, r[0], score(p), score(r)) for k, r in enumerate(fit[:negatives], 1)]
    return sorted(out)


def table_of(rng, n, width, top):
    return [(i, rng.randrange(4), tuple(rng.randrange(-top, top + 1) for _ in range(width))) for i in rng.sample(range(5 * n), n)]


@pytest.mark.parametrize("n,width,top", [(300, 6, 3), (300, 8, 300), (150, 5, 1 << 29), (40, 1, 1)])
def test_equals_brute_force(spark, monkeypatch, n, width, top):
    monkeypatch.setattr(negatives, "BLOCK", 32)  # many blocks and tiles
    monkeypatch.setattr(negatives, "TILE", 8)
    rows = table_of(random.Random(n + width), n, width, top)
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    want = plain(rows, lambda i: i % 5 == 0)
    assert sorted(map(tuple, hard_negatives(df, F.col("id") % 5 == 0).collect())) == want
    few = plain(rows, lambda i: i % 5 == 0, 2, 3, 10, 100)
    assert sorted(map(tuple, hard_negatives(df, F.col("id") % 5 == 0, 2, 3, 10, 100, chunk_bytes=900).collect())) == few
    assert want and few


def test_ties_one_label_with_most_rows_and_equal_vectors(spark):
    rng = random.Random(3)
    rows = [(i, 0 if i % 3 else i % 5, (3, 1, 2)) for i in range(200)] + [(200 + i, 1, (rng.randrange(4), 1, 1)) for i in range(100)]
    got = hard_negatives(spark.createDataFrame(rows, ROWS), F.col("id") % 20 == 0, low=30, high=100)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 20 == 0, low=30, high=100) != []


def test_nulls_repeated_rows_lengths_and_empty_tables(spark):
    good = [(0, 1, (2, 2)), (1, 1, (3, 1)), (2, 2, (1, 1)), (2, 2, (1, 2)), (3, 2, (1, 0)), (4, 1, (2, 2, 2)), (5, 2, (1, 1, 1)), (10, 1, (1, 1, 1)), (20, 3, ())]
    odd = [(None, 2, (1, 1)), (6, None, (1, 1)), (7, 2, None), (8, 2, (None, 1)), (0, 1, (2, 2)), (2, 2, (1, 1))]
    df = spark.createDataFrame(good + odd, ROWS).withColumns({c: F.lit("mine") for c in ("queried", "anchor", "key", "rank", "score")})
    assert sorted(map(tuple, hard_negatives(df, F.col("id") % 10 == 0).collect())) == plain(good, lambda i: i % 10 == 0) != []
    nothing = hard_negatives(spark.createDataFrame([], ROWS), F.col("id") % 10 == 0)
    assert nothing.count() == 0 and nothing.columns[0] == "anchor_id"
    alone = hard_negatives(spark.createDataFrame([(10, 1, (1, 2))], ROWS), F.col("id") % 10 == 0)
    assert alone.count() == 0


def test_products_are_exact_and_end_at_the_range_of_a_long():
    big = np.array([[1 << 40, 1], [(1 << 62), 1 << 62]], np.int64)
    small = np.array([[1 << 20, 1], [-(1 << 62), 3]], np.int64)
    assert scores_of(big, small).tolist() == [[(1 << 60) + 1, -(1 << 63) + 1], [(1 << 63) - 1, -(1 << 63) + 1]]


def test_keys_sort_by_anchor_descending_score_kind_and_id():
    rng = random.Random(1)
    rows = [(rng.randrange(3), rng.choice([-(1 << 62), -1, 0, 1, 5, (1 << 63) - 1]), rng.randrange(2), rng.choice([-7, 0, 3, 1 << 62])) for _ in range(300)]
    keys = packed(*(np.array(c, np.int64) for c in zip(*rows)))
    ordered = [tuple(map(int, r)) for r in zip(*unpacked(sorted(keys)))]
    assert ordered == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))


def test_report_changes_labels_and_leaves_out_what_is_not_finite(spark):
    rng = random.Random(8)
    rows = [(i, rng.randrange(10), [rng.uniform(-1, 1) for _ in range(6)]) for i in range(1200)]
    odd = [(1400, 1, [float("nan")] * 6), (1500, 1, [float("inf"), *[0.0] * 5]), (1600, None, [0.1] * 6), (1700, 2, None), (1800, 2, [None, *[0.5] * 5])]
    df = spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<float>")
    kept = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, tuple(int(np.floor(np.float64(np.float32(x)) * 256)) for x in r.embedding)) for r in df.filter("vec_id < 1200").collect()]
    got = mining_report(df)
    assert sorted(map(tuple, got.collect())) == plain(kept, lambda i: i % 100 == 0) != []
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
