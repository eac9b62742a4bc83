import random

import corpus_pipeline
from helpers import Union, docs_of, prose
from weirflow.llm.simhash import bands, shingle_set


def plain_set(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}


def survivors(texts):
    sets = [plain_set(t) for t in texts]
    union = Union()
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                union.join(i, j)
    return sorted(i for i in range(len(texts)) if union.find(i) == i)


def copies():
    """Texts with copies of all degrees around 0.8, chains, one large group and many with a common line."""
    rng = random.Random(11)
    texts = ["one two", "One TWO", "x"]
    for n in (12, 30, 60, 200, 400):
        for _ in range(4):
            words = prose(rng, n).split()
            texts.append(" ".join(words))
            for changes in (1, 2, 3, n // 60 + 1, n // 40 + 1, n // 25 + 1):
                words = list(words) if changes % 2 else texts[-1].split()
                for _ in range(changes):
                    words[rng.randrange(n)] = f"new{rng.randrange(10**6)}"
                texts.append(" ".join(words))
    base = prose(rng, 120).split()
    texts += [" ".join([*base[:k], f"other{k}", *base[k + 1 :]]) for k in range(100)]
    line = prose(rng, 8)
    texts += [f"{line} {prose(rng, 60)}" for _ in range(60)]
    rng.shuffle(texts)
    return list(dict.fromkeys(texts))


def test_stage_equals_brute_force_jaccard(spark):
    texts = copies()
    docs = docs_of(spark, texts)
    left = corpus_pipeline.near(spark, docs, "")
    assert left.columns == docs.columns
    want = survivors(texts)
    assert sorted(r.doc_id for r in left.collect()) == want
    assert len(want) < len(texts) - 130


def test_near_copies_share_a_key():
    rng = random.Random(12)
    for _ in range(300):
        own = shingle_set(prose(rng, rng.choice([9, 14, 50, 300])), 5)
        other = own[rng.sample(range(len(own)), -(-len(own) * 4 // 5))]  # a subset: 0.8 or a little more
        assert set(bands(own)) & set(bands(other))


def test_empty_null_and_repeated_rows(spark):
    left = corpus_pipeline.near(spark, docs_of(spark, [None, "", "a b", "a b", "c", "c", "A b"], ids=[5, 4, 3, 3, None, None, None]), "")
    assert sorted((repr(r.doc_id) for r in left.collect())) == ["3", "4", "None"]
    assert corpus_pipeline.near(spark, docs_of(spark, []), "").count() == 0
