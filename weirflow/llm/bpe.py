"""Byte-level BPE over a published vocabulary, by a depth-first walk of a trie of words.

A text is cut into words by the vocabulary's own pattern.  Each task puts the distinct words that it
has not met yet into a trie and walks it depth first.  The state of a node is the *last token* of the
encoding of the bytes on its path: the one vocabulary entry that ends there and may follow the last
token of the shorter path.  Two tokens may follow each other if merging their bytes gives just these
two.  A word's encoding is read backwards from its node, and what words share is computed once.

Sorting the words gives the trie in depth-first order: the prefix that a word shares with the one
before is the part of the path that stays on the stack, so the nodes need not be built.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm.common import give_back, made_once, texts, travels, without

FILE = "byte_bpe_50k.json"
# How vocabularies of this kind cut texts into words (the commonest alternative first).
WORDS = r" ?\p{L}+|'(?:[stmd]|re|ve|ll)| ?(?:\p{N}+|[^\s\p{L}\p{N}]+)|\s+(?!\S)|\s+"
# Code points that became letters or numbers after Unicode 16, the version by which the
# tokenizer library tells them; for it they are other signs.
LATER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
    "10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF "
    "18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 "
    "1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 "
    "3D000-3FC3F"
)
KNOWN_WORDS = 150_000  # words of the younger half of what a worker keeps
KNOWN_PAIRS = 400_000  # pairs of tokens whose fit a worker keeps
KNOWN_ENDS = 50_000  # ends of words whose tokens a worker keeps
END = 4  # bytes of such an end
NEVER = 1 << 60  # the rank of pairs that do not merge
LONG_WORD = 200  # longer words are not kept
_GROUP = 1 << 20  # characters whose words are looked up together
_PIECES = 1 << 17  # words of a long text that are held at a time
_TOKENS = 1 << 14  # tokens whose bytes are put together at a time

_NEAR = 0x558  # letters below are old enough for any version of Unicode
_FAR = re.compile("[\u0558-\U0010ffff]")

travels(__name__)


def vocabulary_text(path: str | None = None) -> str:
    """The vocabulary file, read on the driver; tasks get it as a broadcast of a megabyte or two."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(FILE)
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: bytes that print stand for
    themselves, the others for the letters from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def near_members(kind: str, but: str = "") -> str:
    """The members of a class of :mod:`regex` below ``_NEAR``, as the inside of a class of :mod:`re`."""
    told = regex.compile(kind)
    return "".join(rf"\u{c:04x}" for c in range(_NEAR) if told.match(chr(c)) and chr(c) not in but)


def near_pattern(pattern: str) -> re.Pattern:
    """``pattern`` for texts of letters below ``_NEAR`` only, with its classes written out: :mod:`re` cuts
    the same words in half the time."""
    letters, numbers, white = near_members(r"\p{L}"), near_members(r"\p{N}"), near_members(r"\s")
    out = pattern.replace(r"[^\S ]", f"[{near_members(r'\s', but=' ')}]").replace(r"[^\s\p{L}\p{N}]", f"[^{white}{letters}{numbers}]")
    for kind, members in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\s", f"[{white}]"), (r"\S", f"[^{white}]")):
        out = out.replace(kind, members)
    return re.compile(out)


class Pattern:
    """A pattern of words by the Unicode version of the tokenizer library."""

    def __init__(self, pattern: str):
        spans = "".join("-".join(rf"\U{int(c, 16):08x}" for c in span.split("-")) for span in LATER.split())
        later = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{spans}])")
        for kind in "LN":
            later = later.replace(rf"\p{{{kind}}}+", rf"(?:(?![{spans}])\p{{{kind}}})+")
        self.later, self.plain, self.exact = regex.compile(f"[{spans}]"), regex.compile(pattern), regex.compile(later)
        self.near = near_pattern(pattern)

    def on(self, text: str) -> re.Pattern | regex.Pattern:
        """The exact pattern is needed only for letters that are later than the library, all from U+0558 on."""
        if not _FAR.search(text):
            return self.near
        return self.exact if self.later.search(text) else self.plain

    def findall(self, text: str) -> list[str]:
        return self.on(text).findall(text)

    def lists(self, text: str) -> Iterator[list[str]]:
        """The words of a text, in lists of bounded length."""
        if len(text) <= 4 * _GROUP:
            yield self.findall(text)
            return
        found = (m.group() for m in self.on(text).finditer(text))
        while part := list(islice(found, _PIECES)):
            yield part


class Recent:
    """A table of words met lately, of bounded size: words that are still met move on to the younger
    half when the older one is given up."""

    def __init__(self, bound: int):
        self.bound, self.young, self.old = bound, {}, {}
        self.long: set[str] = set()

    def unknown(self, words: set[str]) -> set[str]:
        """Those of ``words`` that must be computed; the others are in ``young`` afterwards."""
        if len(self.young) > self.bound:
            self.old, self.young = self.young, {}
        new = words.difference(self.young)  # a dict, not its keys: only ``words`` are gone through
        again = {w for w in new if w in self.old}
        self.young.update((w, self.old[w]) for w in again)
        new -= again
        if max(map(len, new), default=0) > LONG_WORD:
            self.long.update(w for w in new if len(w) > LONG_WORD)
        return new

    def forget_long(self) -> None:
        for word in self.long:
            self.young.pop(word, None)
            self.old.pop(word, None)
        self.long.clear()


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE without normaliser and added space is built")
        letters = byte_letters()
        self.id_of = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if all(c in letters for c in token)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError("special tokens that take in their surroundings are not built")
            self.id_of.pop(t["content"].encode(), None)
        self.bytes_of = {i: b for b, i in self.id_of.items()} | {i: s.encode() for s, i in self.special.items()}
        self.size_of = {i: len(b) for i, b in self.bytes_of.items()}
        # The bytes of all tokens in one row, by id; an id that no token has takes none.
        every = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.row, self.sizes = np.frombuffer(b"".join(every), np.uint8), np.array([len(b) for b in every], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        raw = {token: i for token, i in model["vocab"].items()}
        self.merge = {(raw[a], raw[b]): (rank, raw[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.words = Pattern(WORDS)
        # Sizes, longest first, of the longer tokens that end with these bytes.
        longer: dict[bytes, set[int]] = defaultdict(set)
        for token in self.id_of:
            if len(token) > END:
                longer[token[-END:]].add(len(token))
        self.longer = {end: tuple(sorted(sizes, reverse=True)) for end, sizes in longer.items()}
        self._ends: dict[bytes, tuple] = {}
        self._follows: dict[int, bool] = {}
        self._made: dict[int, tuple | None] = {}

    def forget(self) -> None:
        """Leave only what the file says."""
        self._ends.clear()
        self._follows.clear()
        self._made.clear()

    def merged(self, data: bytes) -> tuple[list[int], list[tuple[int, int]], list[tuple[int, int]]]:
        """The definition of the encoding: merge the pair of least rank, the leftmost first.

        Gives the ids, and the tokens that stood first and last in turn, each with the rank of the
        merge that made it.  Used once per token of the vocabulary.
        """
        ids = [self.id_of[data[k : k + 1]] for k in range(len(data))]
        first, final = [(ids[0], -1)], [(ids[-1], -1)]
        while len(ids) > 1:
            rank, at, made = self._best(ids)
            if at < 0:
                break
            ids[at : at + 2] = [made]
            if at == 0:
                first.append((made, rank))
            if at == len(ids) - 1:
                final.append((made, rank))
        return ids, first, final

    def _best(self, ids: list[int]) -> tuple[int, int, int]:
        best = (NEVER, -1, -1)
        for k in range(len(ids) - 1):
            found = self.merge.get((ids[k], ids[k + 1]))
            if found and found[0] < best[0]:
                best = (found[0], k, found[1])
        return best

    def _edges(self, token: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]] | None:
        """First and last tokens on the way to ``token``; None if its bytes do not merge into it."""
        if token not in self._made:
            ids, first, final = self.merged(self.bytes_of[token])
            self._made[token] = (first, final) if ids == [token] else None
        return self._made[token]

    def follows(self, before: int, token: int) -> bool:
        """Whether ``token`` may stand after ``before`` (-1: at the start).

        Merges go by rising rank, so what touches the border at any time is known for each side
        alone.  The two tokens stay apart if no pair that meets there merges before one of its sides
        goes on growing; of equal ranks the left one goes first.
        """
        right = self._edges(token)
        if before < 0 or right is None:
            return right is not None
        left, right = self._edges(before)[1], right[0]
        i = j = 0
        while True:
            rank = self.merge.get((left[i][0], right[j][0]), (NEVER,))[0]
            grow_left = left[i + 1][1] if i + 1 < len(left) else NEVER
            grow_right = right[j + 1][1] if j + 1 < len(right) else NEVER
            if rank < grow_left and rank <= grow_right and rank < NEVER:
                return False
            if grow_left == grow_right == NEVER:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def _tokens_at(self, end: bytes) -> tuple[tuple[int, ...], tuple[tuple[int, int], ...]]:
        """Where a word goes on to ``end``, its last bytes: sizes of longer tokens that may end there, and
        (size, token) of the others, longest first."""
        parts = ((len(end) - k, self.id_of.get(end[k:])) for k in range(len(end)))
        return self.longer.get(end, ()), tuple((size, token) for size, token in parts if token is not None)

    def walk(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Depth first over the trie of ``words``: each word with the last tokens on its path (entry d
        is the state after d bytes).  The list changes with the next word."""
        path, last, known, ends, get = b"", [-1], self._follows, self._ends, self.id_of.get
        if len(known) > KNOWN_PAIRS:
            known.clear()
        if len(ends) > KNOWN_ENDS:
            ends.clear()
        known_fit, known_end = known.get, ends.get
        for word in sorted(words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                tail = word[end - END : end] if end > END else word[:end]
                found = known_end(tail)
                if found is None:
                    found = ends[tail] = self._tokens_at(tail)
                longer, others = found
                if longer:
                    more = []
                    for size in longer:
                        if size <= end:
                            token = get(word[end - size : end])
                            if token is not None:
                                more.append((size, token))
                    if more:
                        others = (*more, *others)
                for size, token in others:
                    before = last[end - size]
                    pair = before << 20 | token
                    fits = known_fit(pair)
                    if fits is None:
                        fits = known[pair] = self.follows(before, token)
                    if fits:
                        last.append(token)
                        break
                else:
                    raise ValueError(f"no token ends byte {end} of {word!r}")
            path = word
            yield word, last

    def read_back(self, last: list[int]) -> bytes:
        """The ids of the path, four bytes each."""
        ids, end, size_of = [], len(last) - 1, self.size_of
        while end:
            ids.append(last[end])
            end -= size_of[last[end]]
        ids.reverse()
        return array("i", ids).tobytes()

    def bytes_for(self, ids: np.ndarray) -> bytes:
        """The bytes of tokens, taken from the row of all; ids that no token has are left out."""
        ids, out = ids[(ids >= 0) & (ids < len(self.sizes))], []
        for k in range(0, len(ids), _TOKENS):
            part = ids[k : k + _TOKENS]
            sizes = self.sizes[part]
            at = np.repeat(self.starts[part] - np.cumsum(sizes) + sizes, sizes)
            out.append(self.row[at + np.arange(len(at))].tobytes())
        return b"".join(out)

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of ordinary text (with None) and special tokens (with their id), in order."""
        if self.cut is None or not any(s in text for s in self.special):
            if text:
                yield text, None
            return
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                yield part, self.special[part]
            elif part:
                yield part, None


class Encoder:
    """Encodings of words met so far, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, bound: int = KNOWN_WORDS):
        self.vocabulary, self.recent = vocabulary, Recent(bound)

    def lookup(self, words: set[str]) -> dict[str, bytes]:
        """A table that holds all of ``words``, until the next lookup."""
        by_bytes = {w.encode("utf-8", "surrogatepass"): w for w in self.recent.unknown(words)}
        table = self.recent.young
        for data, last in self.vocabulary.walk(by_bytes):
            table[by_bytes[data]] = self.vocabulary.read_back(last)
        return table

    def encode(self, several: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray] = []
        group: list[list[tuple[list[str] | None, int | None]]] = []
        size = 0

        def close() -> None:
            table = self.lookup(set().union(*(words for parts in group for words, _ in parts if words)))
            for parts in group:
                data = (array("i", [special]).tobytes() if words is None else b"".join(map(table.__getitem__, words)) for words, special in parts)
                out.append(np.frombuffer(b"".join(data), dtype=np.int32))
            group.clear()

        for text in several:
            if len(text) > 4 * _GROUP:
                close()
                size = 0
                out.append(self._long(text))
                continue
            parts = []
            for part, special in self.vocabulary.segments(text):
                parts.append((None, special) if special is not None else (self.vocabulary.words.findall(part), None))
            group.append(parts)
            size += len(text)
            if size > _GROUP:
                close()
                size = 0
        close()
        self.recent.forget_long()
        return out

    def _long(self, text: str) -> np.ndarray:
        parts = []
        for part, special in self.vocabulary.segments(text):
            if special is not None:
                parts.append(np.array([special], dtype=np.int32))
                continue
            for words in self.vocabulary.words.lists(part):
                table = self.lookup(set(words))
                parts.append(np.frombuffer(b"".join(map(table.__getitem__, words)), dtype=np.int32))
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; what is not UTF-8 becomes U+FFFD, and unknown ids are left out."""
        if not isinstance(ids, np.ndarray) or ids.dtype.kind != "i":
            ids = np.array([i for i in ids if i in self.vocabulary.bytes_of], np.int64)
        return self.vocabulary.bytes_for(ids).decode("utf-8", "replace")


def worker_vocabulary(text: str) -> Vocabulary:
    """The vocabulary, built once in a worker."""
    return made_once(("vocabulary", hash(text)), lambda: Vocabulary(text))


@contextmanager
def task_encoder(text: str) -> Iterator[Encoder]:
    """An encoder for one task.  What it has met goes when the task ends, so a worker that waits for its next
    task, or goes on to another stage, holds the vocabulary and no more."""
    encoder = Encoder(worker_vocabulary(text))
    try:
        yield encoder
    finally:
        encoder.recent = None
        encoder.vocabulary.forget()
        give_back()


def encoder_udf(spark: SparkSession, path: str | None = None):
    held = spark.sparkContext.broadcast(vocabulary_text(path))

    @F.pandas_udf("array<int>")
    def encode(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with task_encoder(held.value) as encoder:
            for column in columns:
                yield pd.Series(encoder.encode(column.tolist()))

    # Not to be repeated: an expression over the ids must not encode the text again.
    return encode.asNondeterministic()


def decoder_udf(spark: SparkSession, path: str | None = None):
    held = spark.sparkContext.broadcast(vocabulary_text(path))

    @F.pandas_udf("string")
    def decode(column: pd.Series) -> pd.Series:
        encoder = Encoder(worker_vocabulary(held.value))
        return pd.Series([None if ids is None else encoder.decode(ids) for ids in column], dtype=object)

    return decode


def round_trip_udf(spark: SparkSession, path: str | None = None):
    """Both in one task: the ids of a text, and the text that these ids give."""
    held = spark.sparkContext.broadcast(vocabulary_text(path))

    @F.pandas_udf("ids array<int>, decoded string")
    def both(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with task_encoder(held.value) as encoder:
            for column in columns:
                ids = encoder.encode(column.tolist())
                yield pd.DataFrame({"ids": ids, "decoded": [encoder.decode(i) for i in ids]})

    return both.asNondeterministic()


def encode(docs: DataFrame, text: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` with the token ids of each whole text; null and empty texts have none.

    Special tokens that stand in a text are taken as such, as the library does by default.  Other
    columns pass through, and repeated rows stay repeated.
    """
    return docs.select(*without(docs, [out]), encoder_udf(docs.sparkSession, path)(texts(text)).alias(out))


def decode(tokens: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """The texts of arrays of ids; null for null, empty for none."""
    return tokens.select(*without(tokens, [out]), decoder_udf(tokens.sparkSession, path)(F.col(ids)).alias(out))


def digest_of_ids(ids: str) -> Column:
    """sha-256 of the decimal ids joined by commas, in lowercase hex."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256)


def token_digests(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per row: the id, n_tokens, ids_sha256 and decoded_sha256 of the whole text encoded and decoded."""
    done = docs.select(id_column, round_trip_udf(docs.sparkSession, path)(texts(text)).alias("_t")).select(id_column, "_t.*")
    return done.select(id_column, F.size("ids").cast("bigint").alias("n_tokens"), digest_of_ids("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
