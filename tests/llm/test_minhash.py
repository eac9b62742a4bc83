import random

import numpy as np
import pytest
from helpers import Union, docs_of, prose
from pyspark.sql import functions as F
from weirflow.llm.minhash import band_keys, near_copies, ranked, scattered, signature
from weirflow.llm.setlinks import SKETCH_BITS, odd_sketch, shingle_set


def plain_set(text, size=3):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def plain(texts, ids, above=85, below=100, size=3):
    sets = [plain_set(t, size) for t in texts]
    union = Union()
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and below * len(a & sets[j]) >= above * len(a | sets[j]):
                union.join(ids[i], ids[j])
    return sorted((i, len(s), union.find(i), union.find(i) == i) for i, s in zip(ids, sets))


def variants(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(rng):
    """Copies of all degrees, chains, a group that hangs together over many members, and common passages."""
    texts = ["one two", "One TWO", "x", "", None, " \t", "one two three", "one\ntwo  three"]
    for n in (12, 40, 90, 300):
        for _ in range(3):
            words = prose(rng, n).split()
            texts.append(" ".join(words))
            for changes in (1, 1, 2, 3, n // 30 + 1, n // 20 + 1, n // 12 + 1):
                texts.append(variants(rng, words if changes % 2 else texts[-1].split(), changes))
    base = prose(rng, 90).split()
    texts += [variants(rng, base, rng.randrange(1, 6)) for _ in range(150)]
    line = prose(rng, 12)
    texts += [f"{line} {prose(rng, 60)}" for _ in range(40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_groups_equal_brute_force(spark, seed):
    texts = corpus(random.Random(seed))
    ids = random.Random(seed).sample(range(10_000), len(texts))
    got = near_copies(docs_of(spark, texts, ids=ids))
    assert sorted(map(tuple, got.collect())) == plain(texts, ids)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}


def test_other_sizes_and_similarities(spark):
    texts = corpus(random.Random(7))
    got = near_copies(docs_of(spark, texts), shingle=5, above=80, below=100).collect()
    assert sorted(map(tuple, got)) == plain(texts, list(range(len(texts))), 80, 100, 5)


def test_both_permutations_are_bijections():
    some = np.random.default_rng(1).integers(0, 1 << 32, 1 << 20, dtype=np.uint32)
    some = np.unique(some)
    assert len(np.unique(scattered(some))) == len(some) == len(np.unique(ranked(some.copy())))


def test_coordinates_agree_as_often_as_sets():
    rng, agree, jaccard = random.Random(5), 0.0, 0.0
    for _ in range(200):
        pool = [rng.randrange(1 << 64) for _ in range(120)]
        a, b = (np.array(sorted(pool[lo:hi]), np.uint64) for lo, hi in ((0, 100), (20, 120)))
        agree += float((signature(a) == signature(b)).mean()) / 200
        jaccard += 80 / 120 / 200
    assert abs(agree - jaccard) < 0.02


def test_close_sets_share_a_band():
    rng, missed = random.Random(12), 0
    for _ in range(3000):
        own = np.array(sorted(rng.randrange(1 << 64) for _ in range(rng.choice([20, 60, 200]))), np.uint64)
        other = own[sorted(rng.sample(range(len(own)), -(-len(own) * 85 // 100)))]
        missed += not set(band_keys(signature(own)).tolist()) & set(band_keys(signature(other)).tolist())
    assert missed == 0


def test_odd_sketches_differ_no_more_than_sets():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ({rng.randrange(1 << 64) for _ in range(rng.randrange(400))} for _ in range(2))
        common = {rng.randrange(1 << 64) for _ in range(300)}
        x, y = (odd_sketch(np.array(sorted(s | common), np.uint64)) for s in (a, b))
        assert sum(int(v).bit_count() for v in np.bitwise_xor(x, y).view(np.uint64)) <= len(a ^ b)
    assert len(odd_sketch(np.zeros(0, np.uint64))) == SKETCH_BITS // 64


def test_shingles_are_distinct_and_whole():
    assert len(shingle_set("A b c a B C a b c", 3)) == 3
    assert len(shingle_set("a b", 3)) == 1 and shingle_set("A  b", 3) == shingle_set("a b", 3)
    assert len(shingle_set("\u00a0", 3)) == 1 and len(shingle_set(" \x0b", 3)) == 0
    assert len(shingle_set(" ".join(map(str, range(50_000))), 3)) == 49_998


def test_null_ids_repeated_rows_clashing_columns_and_empty_tables(spark):
    docs = docs_of(spark, ["a b c d", "a b c d", "a b c d", "q", "", None], ids=[9, 4, None, None, 3, 3])
    docs = docs.union(docs.filter("doc_id = 4"))
    docs = docs.withColumns({c: F.lit("mine") for c in ("id", "mark", "fp", "n", "odd", "keys", "s", "component_id", "kept", "n_shingles", "root", "maybe")})
    got = sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.kept) for r in near_copies(docs).collect())
    assert got == [("3", 0, "3", True), ("3", 0, "3", True), ("4", 2, "4", True), ("4", 2, "4", True), ("9", 2, "4", False), ("None", 1, "None", True), ("None", 2, "4", False)]
    assert near_copies(docs_of(spark, [])).count() == 0
    assert near_copies(docs_of(spark, [None, ""])).filter("kept").count() == 2
