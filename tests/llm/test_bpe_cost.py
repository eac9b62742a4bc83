"""The common texts are cut, walked and decoded by the cheaper of equal ways."""

import random
import re

import numpy as np
import pytest
from weirflow.llm import bpe
from weirflow.llm.bpe import WORDS, Encoder, Pattern, Recent, Vocabulary, vocabulary_text
from weirflow.llm.token_counts import UNITS


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(vocabulary_text())


@pytest.mark.parametrize("pattern", [WORDS, UNITS])
def test_near_letters_are_cut_by_the_plain_engine_into_the_same_words(pattern):
    cut, rng = Pattern(pattern), random.Random(5)
    letters = [chr(c) for c in range(0x558)]
    few = [" ", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "'", "'s", "'re", "a", "é", "1", "²", "½", "-", "́"]
    texts = ["".join(letters), " ".join(letters), "a".join(letters), "'s".join(letters)]
    texts += ["".join(rng.choice(rng.choice((letters, few))) for _ in range(40)) for _ in range(500)]
    for text in texts:
        assert isinstance(cut.on(text), re.Pattern)
        assert cut.findall(text) == cut.plain.findall(text) == cut.exact.findall(text)
    assert cut.on("a漢") is cut.plain and cut.on("a՘") is cut.exact


def test_few_ends_are_kept_and_change_nothing(vocabulary, monkeypatch):
    rng = random.Random(6)
    words = {"".join(rng.choice("etaoin éß ") for _ in range(rng.randint(1, 12))).encode() for _ in range(400)} | {b" international", b"aaaaaaaaaaaaaaaa"}
    want = {w: vocabulary.merged(w)[0] for w in words}
    monkeypatch.setattr(bpe, "KNOWN_ENDS", 10)
    for _ in range(2):
        assert {w: np.frombuffer(vocabulary.read_back(last), np.int32).tolist() for w, last in vocabulary.walk(words)} == want
    list(vocabulary.walk([b"a"]))
    assert len(vocabulary._ends) == 1


def test_decoding_in_pieces(vocabulary, monkeypatch):
    encoder, text = Encoder(vocabulary), "naïve <|endoftext|> words, 漢字 and more" * 20
    ids = encoder.encode([text])[0]
    monkeypatch.setattr(bpe, "_TOKENS", 7)
    assert encoder.decode(ids) == encoder.decode(ids.tolist()) == text
    odd = np.array([-1, ids[0], 999_999, ids[1]], np.int32)
    assert encoder.decode(odd) == encoder.decode(odd.tolist()) == encoder.decode(ids[:2])
    assert encoder.decode(np.array([np.nan, ids[0]])) == encoder.decode(ids[:1]) and encoder.decode([None]) == ""


def test_long_words_are_forgotten():
    recent, long = Recent(2), "x" * 500
    for words in ({long, "a"}, {long, "b", "c"}, {long, "d", "e"}):
        new = recent.unknown(words)
        recent.young.update((w, w) for w in new)
    recent.forget_long()
    assert long not in recent.young and long not in recent.old and "e" in recent.young and not recent.long
