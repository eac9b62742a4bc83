import os

import numpy as np
import pytest
from helpers import docs_of
from pyspark.sql import functions as F
from test_langid import sample
from weirflow.llm.common import remainder
from weirflow.llm.langid import TRIGRAMS, drop_unknown, rareness, trigrams

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
NOISE = ["%% 12 # x ##", "1a2b3c4d5e6f7890 %%%", "@@@@ q ==== 0101 ||||", "!?" * 300 + "z", "0123456789" * 20 + "k", "~~~~x~~~~12"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_noise_with_a_letter_goes_and_clean_held_out_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    noise = spark.createDataFrame([(10**9 + k, t, None) for k, t in enumerate(NOISE)], docs.schema)
    left = {r.doc_id for r in drop_unknown(docs.union(noise)).collect()}
    lettered = docs.filter(F.col("text").rlike(r"\p{L}"))
    assert not {i for i in left if i >= 10**9}
    assert {r.doc_id for r in lettered.filter(remainder("doc_id", 3) == 1).collect()} <= left
    assert {r.doc_id for r in lettered.collect()} == left


def test_without_a_learned_language_letterless_texts_go_only(spark):
    texts = [t for t, _ in sample(20, 9)] + [None, "...", "12"]
    unlabelled = docs_of(spark, texts).withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in drop_unknown(unlabelled).collect()) == list(range(20))
    held_out = docs_of(spark, texts).withColumn("lang", F.when(remainder("doc_id", 3) == 1, F.col("lang")))
    assert sorted(r.doc_id for r in drop_unknown(held_out).collect()) == list(range(20))


SHORT = ["q", "x1 z9", "asdf qwer zxcv", "j j j j", "lkjh fdsa poiu", "zzzz zzzz"]


@pytest.mark.skipif(not os.path.isdir(SF.replace("sf0.001", "sf0.01")), reason="test tables are not here")
def test_short_noise_in_known_letters_goes_and_every_lettered_document_stays(spark):
    docs = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text", "lang")
    noise = spark.createDataFrame([(10**9 + k, t, None) for k, t in enumerate(SHORT)], docs.schema)
    left = {r.doc_id for r in drop_unknown(docs.union(noise)).collect()}
    assert not {i for i in left if i >= 10**9}
    lettered = {r.doc_id for r in docs.filter(F.col("text").rlike(r"\p{L}")).collect()}
    assert lettered - left == set()


def test_rareness_is_that_of_whole_texts():
    idf = np.arange(TRIGRAMS, dtype=float)
    assert rareness("A  b", idf) == rareness("a b", idf) == idf[trigrams("a b")].mean()
    assert len(trigrams("")) == 0 and rareness(" ", idf) == TRIGRAMS - 1
    assert len(trigrams("abc " * 1000)) == 3999
