"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

For a word, count[d] = count[d - length of the last token at d] + 1, where the last token at each byte
comes from the trie walk of :mod:`weirflow.llm.bpe`.  A text is a sequence of *units*, a run of white
space and the word after it, whose counts add up.  A unit is needed because a text that ends inside a
run of white space is cut into words in another way than one that goes on: up to the end of the run
the run is one word, after it its last space belongs to the next word.

What is stored per text is the change of the count with each character, as 16-bit numbers; a running
sum gives the count at every prefix, so truncation and budget questions need no encoding.
"""

from __future__ import annotations

import re
from array import array
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from weirflow.llm.bpe import KNOWN_WORDS, Pattern, Recent, Vocabulary, vocabulary_text, worker_vocabulary
from weirflow.llm.common import own_prefix, texts, travels, without, worker_store

TOKEN_LIMIT = 1024
# The words of the vocabulary's pattern, each with the white space before it.
UNITS = r"\s*\p{L}+|(?:\s*[^\S ])?'(?:[stmd]|re|ve|ll)|\s*(?:\p{N}+|[^\s\p{L}\p{N}]+)|\s+"
LATE = {"'re", "'ve", "'ll"}  # one letter short of these, the apostrophe is a word of its own
_GROUP = 1 << 20  # characters whose units are looked up together
_WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*")  # as in the pattern

travels(__name__)


def tokens_in(changes: bytes) -> int:
    return int(np.frombuffer(changes, dtype="<i2").sum(dtype=np.int64))


def tokens_of(parts: list[bytes]) -> int:
    return tokens_in(b"".join(parts))


class PrefixCounter:
    """Per unit: the change of the token count with each character, kept up to a bound."""

    def __init__(self, vocabulary: Vocabulary, bound: int = KNOWN_WORDS):
        self.vocabulary, self.recent = vocabulary, Recent(bound)
        self.units = Pattern(UNITS)

    def _counts(self, words: set[str]) -> dict[str, list[int]]:
        """Token counts at each character of each word (the last entry is the word's)."""
        by_bytes, size_of, out = {w.encode("utf-8", "surrogatepass"): w for w in words}, self.vocabulary.size_of, {}
        counts = [0]
        path = b""
        for data, last in self.vocabulary.walk(by_bytes):
            shared, most = 0, min(len(path), len(data))
            while shared < most and path[shared] == data[shared]:
                shared += 1
            del counts[shared + 1 :]
            for end in range(shared + 1, len(data) + 1):
                counts.append(counts[end - size_of[last[end]]] + 1)
            path, word = data, by_bytes[data]
            if len(word) == len(data):
                out[word] = counts[1:]
            else:  # a character ends where no byte goes on with it
                out[word] = [counts[k] for k in range(1, len(data) + 1) if k == len(data) or data[k] & 0xC0 != 0x80]
        return out

    def lookup(self, units: set[str]) -> dict[str, bytes]:
        """A table that holds the changes of all of ``units``, until the next lookup."""
        new = self.recent.unknown(units)
        table = self.recent.young
        if not new:
            return table
        # Mostly a unit is one word, with one space before it or none.
        runs = {u: _WHITE.match(u).group() for u in new}
        cut = {u: self.vocabulary.words.findall(u) for u, run in runs.items() if run not in ("", " ") or u in LATE}
        words = {u for u in new if u not in cut} | {w for parts in cut.values() for w in parts} | {runs[u] for u in cut if runs[u]} | {"'", "r", "v", "l"}
        counts = self._counts(words)
        for unit in new:
            so_far = counts[unit] if unit not in cut else self._pieced(unit, cut[unit], runs[unit], counts)
            before = 0
            changes = array("h")
            for n in so_far:
                changes.append(n - before)
                before = n
            table[unit] = changes.tobytes()
        return table

    @staticmethod
    def _pieced(unit: str, parts: list[str], run: str, counts: dict[str, list[int]]) -> list[int]:
        """Counts at each character of a unit that is several words, or a late contraction."""
        inside = counts[run][:] if run else []
        if run == unit:
            return inside
        word = parts[-1]
        before = sum(counts[p][-1] for p in parts[:-1])
        own = counts[word][:]
        if word in LATE:
            own[1] = counts["'"][-1] + counts[word[1]][-1]
        return inside + [before + n for n in own[len(_WHITE.match(word).group()) :]]

    def changes(self, text: str) -> bytes:
        """Two bytes per character of ``text``; their running sum is the number of tokens so far."""
        out: list[bytes] = []
        start = so_far = since = 0  # characters and tokens before the part, and where the last special token ended
        for part, special in self.vocabulary.segments(text):
            if special is None:
                found = self._ordinary(part)
                out += found
                so_far += tokens_of(found)
            else:
                out.append(self._special(text[since:start], part, so_far))
                so_far, since = so_far + 1, start + len(part)
            start += len(part)
        return b"".join(out)

    def total(self, text: str) -> int:
        """The tokens of a whole text that holds special tokens; nothing is cut for it."""
        return sum(tokens_of(self._ordinary(part)) if special is None else 1 for part, special in self.vocabulary.segments(text))

    def _ordinary(self, text: str) -> list[bytes]:
        return [b"".join(map(self.lookup(set(units)).__getitem__, units)) for units in self.units.lists(text)]

    def _special(self, tail: str, token: str, so_far: int) -> bytes:
        """Cut short, a special token is ordinary text that goes on after what stands before it: back
        to the last special token (``tail``), and no further than the last word that no cut can change."""
        # A letter or digit ends a word for good once a character of another class follows.
        safe = max((m.start() for m in islice(regex.finditer(r"(?r)(?<=[\p{L}\p{N}])[^\p{L}\p{N}']", tail), 1)), default=0)
        base = tokens_of(self._ordinary(tail[safe:]))
        counts = []
        for end in range(1, len(token)):
            cut = tokens_of(self._ordinary(tail[safe:] + token[:end]))
            counts.append(so_far - base + cut)
        counts.append(so_far + 1)
        return np.diff(np.array(counts, dtype=np.int64), prepend=so_far).astype("<i2").tobytes()

    def batch(self, several: list[str], keep: bool = True) -> list[bytes] | list[int]:
        """:meth:`changes` of each text, or only their numbers of tokens; the units of neighbouring texts
        are looked up together."""
        out, group, size = [], [], 0

        def close() -> None:
            table = self.lookup(set().union(*group))
            found = (b"".join(map(table.__getitem__, units)) for units in group)
            out.extend(found if keep else map(tokens_in, found))
            group.clear()

        for text in several:
            if len(text) > _GROUP or any(s in text for s in self.vocabulary.special):
                close()
                size = 0
                out.append(self.changes(text) if keep else self.total(text))
                continue
            group.append(self.units.findall(text))
            size += len(text)
            if size > _GROUP:
                close()
                size = 0
        close()
        self.recent.forget_long()
        return out


def _counter(text: str) -> PrefixCounter:
    store = worker_store("counters")
    key = hash(text)
    if key not in store:
        store[key] = PrefixCounter(worker_vocabulary(text))
    return store[key]


def prefix_counts(docs: DataFrame, text: str = "text", path: str | None = None, keep: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens`` of each whole text and, if ``keep``, ``prefix_changes``: for each
    character the change of the count, two bytes each, little-endian.

    Null and empty texts count 0.  Special tokens that stand in a text count one, as the library does
    by default.  Other columns pass through, and repeated rows stay repeated.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary_text(path))

    @F.pandas_udf("n bigint, changes binary")
    def both(column: pd.Series) -> pd.DataFrame:
        changes = _counter(held.value).batch(column.tolist())
        return pd.DataFrame({"n": list(map(tokens_in, changes)), "changes": changes})

    @F.pandas_udf("bigint")
    def only(column: pd.Series) -> pd.Series:
        return pd.Series(_counter(held.value).batch(column.tolist(), keep=False), dtype="int64")

    if not keep:
        return docs.select(*without(docs, ["n_tokens"]), only(texts(text)).alias("n_tokens"))
    rest = without(docs, ["n_tokens", "prefix_changes"])
    counted = f"{own_prefix(docs)}counted"
    done = docs.withColumn(counted, both(texts(text)))
    return done.select(*rest, F.col(f"{counted}.n").alias("n_tokens"), F.col(f"{counted}.changes").alias("prefix_changes"))


@F.pandas_udf(LongType())
def tokens_at(changes: pd.Series, characters: pd.Series) -> pd.Series:
    """Tokens of the first ``characters`` characters (null where either is null)."""
    return pd.Series([None if c is None or pd.isna(n) else int(np.frombuffer(c, dtype="<i2")[: max(0, int(n))].sum(dtype=np.int64)) for c, n in zip(changes, characters)], dtype="Int64")


@F.pandas_udf(LongType())
def longest_within(changes: pd.Series, budget: pd.Series) -> pd.Series:
    """The most characters whose prefix has no more than ``budget`` tokens (null where either is null)."""

    def most(c: bytes, n: int) -> int:
        fits = np.flatnonzero(np.cumsum(np.frombuffer(c, dtype="<i2"), dtype=np.int64) <= n)
        return int(fits[-1]) + 1 if len(fits) else 0

    return pd.Series([None if c is None or pd.isna(n) else most(c, int(n)) for c, n in zip(changes, budget)], dtype="Int64")


def token_report(docs: DataFrame, id_column: str = "doc_id", text: str = "text", limit: int = TOKEN_LIMIT, path: str | None = None) -> DataFrame:
    """Per row: the id, n_bytes, n_tokens and over_limit (more tokens than ``limit``)."""
    sized = docs.select(id_column, text, F.octet_length(texts(text)).cast("bigint").alias("n_bytes"))
    counted = prefix_counts(sized, text, path, keep=False)
    return counted.select(id_column, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
