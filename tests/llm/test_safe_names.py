"""Columns of the user's table that are named like helper columns stay as they are; executors need no copy of the package."""

import os
import subprocess
import sys
import textwrap

import corpus_pipeline
import pytest
from helpers import docs_of, prose
from pyspark.sql import functions as F
from weirflow.llm import decontaminate, exact_dedup, langid, sharding, simhash, token_counts
from test_langid import sample

import random

NAMES = (
    "_id", "_mark", "_spot", "_map", "_n", "_keep", "_length", "_prefix", "_full", "_crowded", "_doubtful", "_maybe", "_gone", "_row", "_found", "_known", "_knows", "_counted", "_m",
    "_bin", "_part", "_order", "_rank", "_from", "_to", "_slot", "__id", "__n", "___map", "id", "mark", "fp", "root", "m", "found", "first",
)


def clashing(docs):
    """``docs`` with a text, of the row's own, in a column of each name."""
    return docs.withColumns({n: F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")) for n in NAMES})


def untouched(rows, n):
    rows = rows.collect()
    assert len(rows) == n
    for row in rows:
        assert all(row[c] == f"{c}-{row.doc_id}" for c in NAMES)


def texts():
    rng = random.Random(2)
    base = prose(rng, 60)
    return [base, base, base + " more", prose(rng, 40), "", None, *[t for t, _ in sample(30, 4)]]


ITEMS = "item_id long, text string"


def test_operators_keep_columns_named_like_their_helpers(spark):
    docs = clashing(docs_of(spark, texts()))
    n = docs.count()
    untouched(exact_dedup.exact_groups(docs), n)
    untouched(sharding.assign(docs, 3), n)
    untouched(token_counts.prefix_counts(docs), n)
    untouched(langid.identify(docs, langid.train(docs_of(spark, [t for t, _ in sample(60, 1)], [g for _, g in sample(60, 1)]))), n)
    items = spark.createDataFrame([(1, prose(random.Random(9), 40))], ITEMS)
    assert decontaminate.contaminated(docs, items).count() == 0


def test_stages_keep_columns_named_like_their_helpers(spark):
    docs = clashing(docs_of(spark, texts()))
    untouched(exact_dedup.drop_exact(docs), 34)
    untouched(simhash.drop_near(docs, shingle=5, similarity=0.8), 33)
    untouched(simhash.drop_near(docs), 34)  # one word more is more than two bits
    untouched(decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, prose(random.Random(9), 40))], ITEMS)), 36)
    untouched(corpus_pipeline.language_id(spark, docs, ""), 34)


def test_one_row_stays_of_rows_that_repeat(spark):
    docs = docs_of(spark, ["a b", "a b", "a b", "c", "c", "d", "d"], ids=[1, 1, 0, None, None, 2, 2]).withColumn("tags", F.create_map(F.lit("k"), F.lit(1)))
    assert sorted(repr(r.doc_id) for r in exact_dedup.drop_exact(docs).collect()) == ["1", "2", "None"]
    assert sorted(repr(r.doc_id) for r in simhash.drop_near(docs, shingle=5, similarity=0.8).collect()) == ["0", "2", "None"]


WITHOUT_PACKAGE = """
    import sys
    sys.path[:0] = [{root!r}, {tests!r}]
    from helpers import docs_of, prose
    from test_langid import sample
    from weirflow.llm import decontaminate, langid, minhash, negatives, runs, toxicity
    from pyspark.sql import functions as F
    from weirflow.session import local_session
    import random
    spark = local_session("bare", "2", shuffle_partitions=2, memory="2g")
    few = sample(60, 1)
    docs = docs_of(spark, [t for t, _ in few], [g for _, g in few])
    item = prose(random.Random(3), 40)
    model = langid.train(docs)
    assert langid.identify(docs, model).filter("lang_pred <> 'und'").count() == 60
    assert langid.drop_unknown(docs).count() > 50
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert decontaminate.contaminated(docs_of(spark, [item, "x"]), items).count() == 1
    assert decontaminate.drop_contaminated(docs_of(spark, [item, "x"]), items).count() == 1
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic")
    assert toxicity.score(docs, toxicity.train(docs, labels, rounds=1)).count() == 60
    assert minhash.near_copies(docs).count() == 60 and runs.find_runs(docs).count() == 60
    rows = spark.createDataFrame([(i, i % 2, [i, 1]) for i in range(40)], "id long, label long, vector array<long>")
    assert negatives.hard_negatives(rows, F.col("id") % 10 == 0).count() >= 0
    print("all well")
"""


@pytest.mark.skipif(sys.platform != "linux", reason="workers inherit the environment there")
def test_executors_need_no_copy_of_the_package(tmp_path):
    here = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(os.path.dirname(here))
    script = tmp_path / "bare.py"
    script.write_text(textwrap.dedent(WITHOUT_PACKAGE.format(root=root, tests=here)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all well" in done.stdout, done.stderr[-3000:]
