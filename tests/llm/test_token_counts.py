import numpy as np
import public_tokenizers
import pytest
from helpers import docs_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_bpe import PARTS
from tokenizers import Tokenizer
from weirflow.llm.bpe import FILE, Vocabulary, vocabulary_text
from weirflow.llm.token_counts import PrefixCounter, longest_within, prefix_counts, token_report, tokens_at


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(FILE))


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(Vocabulary(vocabulary_text()), bound=100)


def counts(counter, text):
    return np.cumsum(np.frombuffer(counter.batch([text])[0], dtype="<i2"), dtype=np.int64).tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=2), max_size=12).map("".join))
def test_every_prefix_equals_the_library(library, counter, text):
    assert counts(counter, text) == [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]


def test_long_text(library, counter):
    text = "some words don't   end\n\nhere " * 200_000
    assert counts(counter, text)[-1] == len(library.encode(text, add_special_tokens=False).ids)


def test_frames_answer_truncation_and_budgets(spark, library):
    texts = [None, "", "Hello   world, it's <|endoftext|> over", "x " * 2000]
    docs = docs_of(spark, texts).withColumnRenamed("source", "n_tokens")
    kept = prefix_counts(docs)
    rows = {r.doc_id: r for r in kept.select("doc_id", "n_tokens", tokens_at("prefix_changes", F.lit(9)).alias("nine"), longest_within("prefix_changes", F.lit(3)).alias("three")).collect()}
    for k, t in enumerate(texts):
        n = lambda s: len(library.encode(s, add_special_tokens=False).ids)
        t = t or ""
        assert rows[k].n_tokens == n(t) and rows[k].nine == n(t[:9])
        assert rows[k].three == max([0, *(c for c in range(1, min(len(t), 60) + 1) if n(t[:c]) <= 3)])
    report = {r.doc_id: r for r in token_report(docs_of(spark, texts)).collect()}
    assert [report[k].n_bytes for k in range(4)] == [0, 0, len(texts[2]), 4000]
    assert [report[k].over_limit for k in range(4)] == [False, False, False, True]
    assert token_report(docs_of(spark, [])).count() == 0


def test_many_special_strings_take_time_by_the_length_of_the_text():
    import time

    from weirflow.llm.bpe import Vocabulary, vocabulary_text
    from weirflow.llm.token_counts import tokens_in

    counter = PrefixCounter(Vocabulary(vocabulary_text()))
    few, many = "<|endoftext|>ab " * 40, "<|endoftext|>ab " * 20_000
    began = time.time()
    assert counter.batch([many], keep=False)[0] == 500 * counter.batch([few], keep=False)[0]
    assert time.time() - began < 10
    began, some = time.time(), "<|endoftext|>ab " * 2_000
    assert tokens_in(counter.changes(some)) == 50 * tokens_in(counter.changes(few))
    assert time.time() - began < 20
