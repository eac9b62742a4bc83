"""Small tables and plain reference versions for the tests of the llm package."""

from __future__ import annotations

import random

STOCK = "the river went by and no one saw how cold its deep water was that long winter evening near old mill"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, langs=None, ids=None):
    langs = langs or ["en"] * len(texts)
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, g, "s", None if t is None else len(t)) for i, t, g in zip(ids, texts, langs)], DOC)


def prose(rng: random.Random, n: int, stock: str = STOCK) -> str:
    words = stock.split()
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ing", "er", "ed"]) + str(rng.choice("abcdefgh")) for _ in range(n))


class Union:
    """Union-find that names a set by its least member."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
