import hashlib
from collections import defaultdict

import pytest
from helpers import docs_of
from weirflow.llm.exact_dedup import drop_exact, exact_groups

TEXTS = ["a", "a", None, "", "b" * 70, "b" * 70 + "x", "b" * 70 + "y", "b" * 70 + "x", "c", "a ", "A", "ä", "ä", "long " * 5000, "long " * 5000]


def plain(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [(32768, 32768), (1 << 20, 1 << 20)])
def test_groups_equal_a_plain_grouping(spark, bits):
    ids = [5, 3, 7, 9, 1, 2, 4, 6, None, 8, 10, 11, 12, 13, 14]
    docs = docs_of(spark, TEXTS, ids=ids)
    got = exact_groups(docs, length_bits=bits[0], prefix_bits=bits[1]).select("doc_id", "keep_id", "group_size", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(list(zip(ids, TEXTS)))


def test_one_group_of_a_third_and_repeated_rows(spark):
    texts = ["same text"] * 400 + [f"text {k}" for k in range(800)]
    rows = [*enumerate(texts), (3, "same text"), (900, texts[900])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


def test_null_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "x", 1, "k"), (None, "x", 2, "k"), (None, "y", 3, "k"), (1, "y", 4, "k")], "doc_id long, text string, _length int, keep_id string")
    got = exact_groups(docs)
    assert sorted((tuple(r) for r in got.select("doc_id", "text", "keep_id", "kept").collect()), key=repr) == sorted(
        [(None, "x", None, True), (None, "x", None, True), (None, "y", 1, False), (1, "y", 1, True)], key=repr
    )


def test_empty_table(spark):
    assert exact_groups(docs_of(spark, [])).count() == 0


def test_stage_keeps_columns_and_one_of_each(spark):
    docs = docs_of(spark, TEXTS)
    left = drop_exact(docs)
    assert left.columns == docs.columns
    assert sorted(hashlib.md5((r.text or "").encode()).hexdigest() for r in left.collect()) == sorted({hashlib.md5((t or "").encode()).hexdigest() for t in TEXTS})
