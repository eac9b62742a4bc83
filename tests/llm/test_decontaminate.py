import random
from collections import Counter

import numpy as np
import pytest
from helpers import docs_of, prose
from weirflow.llm.decontaminate import Index, contaminated, drop_contaminated, near_share, question_and_answer, units_of, words_of

ITEM = "item_id long, text string"


@pytest.fixture(scope="module")
def items():
    rng = random.Random(1)
    return [(k, f"{prose(rng, rng.randint(10, 70))}. {prose(rng, rng.randint(3, 12))}.") for k in range(60)]


def index_of(items):
    units = [u for _, t in items for u in units_of(words_of(t))]
    return Index.build([(k, t, None) for k, t in items], Counter(w for u in units for w in set(u)), len(units), sum(map(len, units)) / len(units))


def test_retrieval_equals_scoring_all_units(items):
    index, rng = index_of(items), random.Random(2)
    for _ in range(200):
        text = prose(rng, 90) if rng.random() < 0.5 else rng.choice(items)[1] + prose(rng, 40)
        query = [t for t in np.unique(index.numbers(text)).tolist() if t != len(index.terms)]
        scores = Counter()
        for t in query:
            for unit, s in zip(index.postings[t], index.impacts[t]):
                scores[unit] += s
        for threshold in (0.1, 0.3, 0.6):
            assert {u for u, s in scores.items() if s >= threshold - 1e-9} == {u for u, _ in index.retrieve(query, threshold)}


def test_bounds_lose_no_passage(items):
    index, rng = index_of(items), random.Random(3)
    for _ in range(60):
        words = (prose(rng, 200) + " " + rng.choice(items)[1] + " " + prose(rng, 150)).split()
        ids = index.numbers(" ".join(words))
        starts = range(0, max(1, len(ids) - 48), 48)
        want = {k for k, s in enumerate(starts) if index.retrieve([t for t in np.unique(ids[s : s + 96]).tolist() if t != len(index.terms)])}
        assert want and want <= set(index.promising(ids, len(starts)).tolist())


def test_question_and_answer():
    assert question_and_answer("What is it? A stone.") == (["what", "is", "it"], ["a", "stone"])
    assert question_and_answer("One sentence only") == (["one", "sentence", "only"],) * 2
    assert question_and_answer("Q", "A b") == (["q"], ["a", "b"])


@pytest.mark.parametrize("shard_bytes", [1 << 22, 600])
def test_planted_items_are_found_and_clean_texts_are_not(spark, items, shard_bytes):
    rng = random.Random(5)
    texts, want = [], set()
    for k in range(120):
        text = prose(rng, rng.randint(0, 400))
        if k % 3 == 0:
            item, leak = rng.choice(items)
            text = f"{text} {leak.upper() if k % 2 else leak} {prose(rng, 20)}"
            want.add((k, item))
        elif k % 3 == 1:  # the question alone is no leak
            text += " " + " ".join(rng.choice(items)[1].split()[:4])
        texts.append(text)
    table = spark.createDataFrame(items, ITEM)
    docs = docs_of(spark, texts)
    rows = contaminated(docs, table, shard_bytes=shard_bytes).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
    left = drop_contaminated(docs, table, shard_bytes=shard_bytes)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(range(120)) - {d for d, _ in want}


def test_a_leak_deep_in_a_very_long_text(spark, items):
    rng = random.Random(6)
    text = prose(rng, 30_000) + " " + items[3][1] + " " + prose(rng, 30_000)
    assert {r.item_id for r in contaminated(docs_of(spark, [text]), spark.createDataFrame(items, ITEM)).collect()} == {3}


def test_nulls_empty_and_repeated(spark, items):
    table = spark.createDataFrame([(1, None), (2, ""), (None, "!?"), (4, items[0][1]), (4, items[0][1]), (5, items[0][1])], ITEM)
    docs = docs_of(spark, [None, "", items[0][1], items[0][1]], ids=[1, 2, 3, 3]).withColumnRenamed("source", "item_id")
    assert sorted((r[0], r[1]) for r in contaminated(docs, table).collect()) == [(3, 4), (3, 4), (3, 5), (3, 5)]
    assert sorted(r.doc_id for r in drop_contaminated(docs, table).collect()) == [1, 2]
    nothing = spark.createDataFrame([], ITEM)
    assert contaminated(docs, nothing).count() == 0 and drop_contaminated(docs, nothing).count() == 4
    assert contaminated(docs_of(spark, []), table).count() == 0


def plain_edits(part, around):
    """Fewest word edits from ``part`` to a stretch of ``around``."""
    row = [0] * (len(around) + 1)
    for k, word in enumerate(part, 1):
        new = [k]
        for j, other in enumerate(around, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (word != other)))
        row = new
    return min(row)


def test_shares_of_short_parts_equal_an_edit_table():
    rng = random.Random(6)
    for _ in range(400):
        part = [rng.randrange(4) for _ in range(rng.randint(1, 29))]
        around = [rng.randrange(5) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            around += part[: rng.randint(0, len(part))] + [9] + part[rng.randint(0, len(part)) :]
        assert near_share(part, around) == pytest.approx(1 - plain_edits(part, around) / len(part))


def test_items_with_one_word_replaced_are_found(items):
    """Recall over every place of every item; texts made of the same words hold nothing."""
    index, rng, found, tried = index_of(items), random.Random(7), 0, 0
    for item, text in items:
        words = text.split()
        for place in range(len(words)):
            edited = " ".join([*words[:place], "replaced", *words[place + 1 :]])
            found += item in {m[0] for m in index.matches(f"{prose(rng, 60)} {edited} {prose(rng, 60)}")}
            tried += 1
    assert found / tried > 0.97
    assert not any(index.matches(prose(rng, 400)) for _ in range(300))


def test_with_an_answer_of_its_own_both_parts_must_be_there():
    rng = random.Random(8)
    question, answer = prose(rng, 20), prose(rng, 6)
    words = words_of(f"{question} {answer}")
    index = Index.build([(1, question, answer)], Counter(words), 1, len(words))
    assert index.matches(f"{prose(rng, 30)} {question} {prose(rng, 5)} {answer}")
    assert not index.matches(f"{prose(rng, 30)} {question} {prose(rng, 5)}")
