import hashlib

import public_tokenizers
import pytest
from helpers import docs_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from weirflow.llm.bpe import FILE, Encoder, Recent, Vocabulary, decode, encode, token_digests, vocabulary_text

PARTS = ["a", "b", "th", "er", "'", "'s", "'re", "'ll", "'t", " ", "  ", "\n", "\t", "é", "ß", "1", "23", "###", "<|endoftext|>", "<|end", "՘", "\x1c", "　", "漢", "😀", "The", "...", "aaaa"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(FILE))


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Vocabulary(vocabulary_text()), bound=200)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=3), max_size=20).map("".join))
def test_encoding_equals_the_library(library, encoder, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert encoder.encode([text])[0].tolist() == want
    assert encoder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_long_texts_and_words(library, encoder):
    for text in ["a" * 5000, "word and another " * 300_000, "é" * 2001 + " <|endoftext|> x" * 5]:
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_recent_words_stay():
    recent = Recent(2)
    for word in "abcdefg":
        for w in recent.unknown({word, "hot"}):
            recent.young[w] = w
    assert "hot" in recent.young and len(recent.young) + len(recent.old) <= 8


def test_frames(spark, library):
    texts = [None, "", "Hello <|endoftext|> world", "plain text", "plain text", "naïve ½ 漢字"]
    docs = docs_of(spark, texts).withColumnRenamed("source", "ids")
    made = encode(docs)
    back = {r.doc_id: r for r in decode(made).collect()}
    for k, t in enumerate(texts):
        assert list(back[k].ids) == library.encode(t or "", add_special_tokens=False).ids and back[k].decoded == (t or "")
    rows = {r.doc_id: r for r in token_digests(docs_of(spark, texts)).collect()}
    for k, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert rows[k].n_tokens == len(ids)
        assert rows[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert encode(docs_of(spark, [])).count() == 0


def test_decoding_of_odd_ids(spark, encoder):
    rows = spark.createDataFrame([(1, [50256]), (2, []), (3, None), (4, [222]), (5, [999999])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in decode(rows).collect()}
    assert got[1] == "<|endoftext|>" and got[2] == "" and got[3] is None and got[5] == "" and got[4] == encoder.decode([222])
