"""Benchmark decontamination: BM25 with block-max WAND over an inverted index of test items.

The test items are the indexed side, in units of at most ``UNIT`` words; every passage of every
document is a query.  Passages are windows of twice ``UNIT`` words, every ``UNIT`` words, so that each
unit that stands in a document lies whole in one of them.  Impacts are BM25 scores divided by the
unit's own score, so a passage that holds a unit scores 1 whatever its length, and all units above
``THRESHOLD`` are retrieved: cursors over postings, a pivot from the terms' upper bounds, and the
maxima of blocks of units to skip what cannot reach the threshold.  The block maxima are first summed
for all passages of a document at once, the frequent terms by what they can give a block at most;
only passages with a block that may reach the threshold are walked by cursors.  What is retrieved is
verified: the item's question and its answer must be there, each to ``OVERLAP``; an item without an answer
of its own must be there as a whole to ``OVERLAP``.  The overlap of a part is the share of its five-word
shingles that are there, of a part of less than ``SHORT`` words the share that is left after the
fewest edits (words replaced, added or left out) that turn the part into a stretch of the passage.

The index is built from tables: term statistics cover all items, and the items are dealt into shards
of bounded size, so that what is broadcast at a time does not grow with the benchmark.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import own_prefix, sent, texts, travels, write_table

UNIT = 48
THRESHOLD = 0.6
SHINGLE = 5
SHORT = 30  # words below which a part is compared by edits, since one edit breaks up to five shingles
OVERLAP = 0.8
K1, B = 1.2, 0.75
BLOCK = 4  # units of a block
FREQUENT = 0.03  # terms in a larger share of the units (and in more than 8) count as frequent
SHARD_BYTES = 4 << 20  # text of the items of one index
_SLICE = 1 << 22  # characters of a long text that are cut into words at a time
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")

travels(__name__)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str, answer: str | None = None) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer.  Where the answer has no column of its own it is the
    last sentence; an item of one sentence is both."""
    if answer is not None and words_of(answer):
        return words_of(text), words_of(answer)
    sentences = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    if len(sentences) < 2:
        return words_of(text), words_of(text)
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def units_of(words: list[str]) -> list[list[str]]:
    """Equal parts of at most ``UNIT`` words."""
    parts = math.ceil(len(words) / UNIT)
    return [words[len(words) * k // parts : len(words) * (k + 1) // parts] for k in range(parts)]


def shingles(ids: list[int], size: int) -> set[tuple[int, ...]]:
    return set(zip(*(ids[k:] for k in range(size))))


def near_share(part: list[int], around: list[int]) -> float:
    """1 - edits / length for the stretch of ``around`` that is fewest word edits away from ``part``: one
    line of the edit table at a time, as differences in the bits of two numbers."""
    n = len(part)
    at: dict[int, int] = {}
    for k, word in enumerate(part):
        at[word] = at.get(word, 0) | 1 << k
    whole, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, edits = whole, 0, n
    best = edits
    for word in around:
        equal = at.get(word, 0)
        zero = (((equal & plus) + plus) ^ plus) | equal | minus
        more, less = minus | ~(zero | plus) & whole, plus & zero
        edits += ((more & top) != 0) - ((less & top) != 0)
        more, less = more << 1 & whole, less << 1 & whole  # a stretch may begin anywhere
        plus, minus = less | ~(zero | more) & whole, more & zero
        best = min(best, edits)
    return 1 - best / n


def overlap(part: tuple[list[int], set[tuple[int, ...]]], around: list[int], sets: dict[int, set]) -> float:
    """How much of a part (its words and shingles) the words ``around`` hold; ``sets`` keeps their shingles by size."""
    words, own = part
    if len(words) < SHORT:
        return near_share(words, around)
    if SHINGLE not in sets:
        sets[SHINGLE] = shingles(around, SHINGLE)
    return len(own & sets[SHINGLE]) / len(own)


@dataclass
class Index:
    """Postings of the units of some items, with the bounds that WAND needs."""

    item_ids: list
    item_words: list[int]
    parts: list[list[tuple[list[int], set[tuple[int, ...]]]]]  # per item: words and shingles of question, answer and, without an answer column, the whole
    unit_item: list[int]
    terms: dict[str, int]
    postings: list[list[int]]
    impacts: list[list[float]]
    upper: np.ndarray  # by term; the last entry, for unknown words, is 0
    block_upper: list[dict[int, float]]
    blocks: int
    frequent_upper: np.ndarray  # by block: the most that its frequent terms can give one unit
    frequent: np.ndarray  # by term: its upper bound if it is frequent, else 0
    rare_at: np.ndarray  # by term: where its blocks begin in the next two; frequent terms have none
    rare_block: np.ndarray
    rare_upper: np.ndarray

    @classmethod
    def build(cls, items: list[tuple], frequency: dict[str, int], units: int, mean_length: float) -> Index:
        """``items``: (id, text, answer or None)."""
        terms: dict[str, int] = {}
        held: dict[int, list[tuple[int, float]]] = defaultdict(list)
        ids, sizes, parts, unit_item = [], [], [], []
        for item, text, answer in items:
            question, reply = question_and_answer(text, answer)
            whole = words_of(text if answer is None else f"{text}\n{answer}")
            if not whole:
                continue
            own = []
            for part in (question, reply) if answer is not None and words_of(answer) else (question, reply, whole):
                numbers = [terms.setdefault(w, len(terms)) for w in part]
                own.append((numbers, shingles(numbers, SHINGLE)))
            for unit in units_of(whole):
                count = Counter(unit)
                length = K1 * (1 - B + B * len(unit) / mean_length)
                score = {}
                for w, tf in count.items():
                    df = frequency[w]
                    score[terms.setdefault(w, len(terms))] = math.log(1 + (units - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + length)
                total = sum(score.values())
                for t, s in score.items():
                    held[t].append((len(unit_item), s / total))
                unit_item.append(len(ids))
            ids.append(item), sizes.append(len(whole)), parts.append(own)
        postings = [[u for u, _ in held[t]] for t in range(len(terms))]
        impacts = [[s for _, s in held[t]] for t in range(len(terms))]
        block_upper: list[dict[int, float]] = []
        for t in range(len(terms)):
            blocks: dict[int, float] = {}
            for u, s in held[t]:
                blocks[u // BLOCK] = max(blocks.get(u // BLOCK, 0.0), s)
            block_upper.append(blocks)
        upper = np.array([max(i, default=0.0) for i in impacts] + [0.0])
        n_blocks = len(unit_item) // BLOCK + 1
        often = [len(own) > max(8, FREQUENT * len(unit_item)) for own in postings]
        by_unit = np.zeros(len(unit_item))
        for t, own in enumerate(postings):
            if often[t]:
                by_unit[own] += impacts[t]
        frequent_upper = np.array([by_unit[b * BLOCK : (b + 1) * BLOCK].max(initial=0.0) for b in range(n_blocks)])
        rare = [sorted(b.items()) if not o else [] for b, o in zip(block_upper, often)] + [[]]
        rare_at = np.concatenate(([0], np.cumsum([len(r) for r in rare])))
        flat = [x for r in rare for x in r]
        return cls(
            ids, sizes, parts, unit_item, terms, postings, impacts, upper, block_upper, n_blocks, frequent_upper, np.where([*often, False], upper, 0.0),
            rare_at, np.array([b for b, _ in flat], dtype=np.int64), np.array([u for _, u in flat], dtype=np.float64),
        )

    def retrieve(self, query: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Block-max WAND: all units whose score for the distinct terms of ``query`` reaches the threshold."""
        least = threshold - 1e-9
        upper, out = self.upper, []
        cursors = [[self.postings[t][0], 0, t] for t in query if self.postings[t]]  # unit, place in the postings, term

        def forward(cursor: list, unit: int) -> None:
            cursor[1] = bisect_left(self.postings[cursor[2]], unit, cursor[1])
            own = self.postings[cursor[2]]
            cursor[0] = own[cursor[1]] if cursor[1] < len(own) else math.inf

        while True:
            cursors.sort()
            while cursors and cursors[-1][0] == math.inf:
                cursors.pop()
            bound, pivot = 0.0, -1
            for k, cursor in enumerate(cursors):
                bound += upper[cursor[2]]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                return out
            unit = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == unit:
                pivot += 1
            block = unit // BLOCK
            if sum(self.block_upper[c[2]].get(block, 0.0) for c in cursors[: pivot + 1]) >= least:
                if cursors[0][0] == unit:
                    score = sum(self.impacts[c[2]][c[1]] for c in cursors[: pivot + 1])
                    if score >= least:
                        out.append((unit, score))
                    onward = unit + 1
                else:
                    onward = unit
            else:
                onward = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    onward = min(onward, cursors[pivot + 1][0])
            for cursor in cursors[: pivot + 1]:
                if cursor[0] < onward:
                    forward(cursor, onward)

    def promising(self, ids: np.ndarray, passages: int) -> np.ndarray:
        """Passages with a block whose bound reaches the threshold: the sum of the block maxima of the
        rare terms, and for the frequent ones the lesser of their own bounds and of the block's."""
        least, out = THRESHOLD - 1e-9, []
        common = np.concatenate(([0.0], np.cumsum(self.frequent[ids])))
        at_once = max(1, (1 << 21) // self.blocks)
        for first in range(0, passages, at_once):
            last = min(passages, first + at_once)
            low, high = first * UNIT, min(len(ids), (last + 1) * UNIT)
            part = ids[low:high]
            begin, count = self.rare_at[part], self.rare_at[part + 1] - self.rare_at[part]
            place = np.repeat(np.arange(low, high), count)
            entry = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
            block, value = self.rare_block[entry], self.rare_upper[entry]
            bound = np.zeros((last - first) * self.blocks)
            for passage in (place // UNIT - first, place // UNIT - first - 1):
                own = (passage >= 0) & (passage < last - first)
                bound += np.bincount(passage[own] * self.blocks + block[own], weights=value[own], minlength=len(bound))
            starts = np.arange(first, last) * UNIT
            often = common[np.minimum(starts + 2 * UNIT, len(ids))] - common[starts]
            bound = bound.reshape(last - first, self.blocks) + np.minimum(often[:, None], self.frequent_upper)
            out.append(first + np.flatnonzero(bound.max(axis=1) >= least))
        return np.concatenate(out)

    def numbers(self, text: str) -> np.ndarray:
        """Term numbers of the words of a whole text; the number of terms stands for unknown words."""
        unknown, get, found, start = len(self.terms), self.terms.get, [], 0
        text = text.lower()
        while start < len(text):
            stop = min(len(text), start + _SLICE)
            while stop < len(text) and _WORD.match(text[stop - 1]) and _WORD.match(text[stop]):
                stop += 1
            words = _WORD.findall(text, start, stop)
            found.append(np.fromiter((get(w, unknown) for w in words), dtype=np.int32, count=len(words)))
            start = stop
        return np.concatenate(found) if found else np.zeros(0, np.int32)

    def matches(self, text: str) -> list[tuple]:
        """(item id, score, overlap of the question, overlap of the answer) of the items found in a text."""
        ids = self.numbers(text)
        if not len(ids) or not self.terms:
            return []
        unknown = len(self.terms)
        passages = len(range(0, max(1, len(ids) - UNIT), UNIT))
        found: dict[int, tuple] = {}
        for passage in self.promising(ids, passages).tolist():
            start, stop = passage * UNIT, min(len(ids), (passage + 2) * UNIT)
            query = np.unique(ids[start:stop])
            best: dict[int, float] = {}
            for unit, score in self.retrieve([t for t in query.tolist() if t != unknown]):
                item = self.unit_item[unit]
                best[item] = max(best.get(item, 0.0), score)
            for item, score in best.items():
                around = ids[max(0, start - self.item_words[item]) : stop + self.item_words[item]].tolist()
                sets: dict[int, set] = {}
                overlaps = [overlap(part, around, sets) if part[0] else 1.0 for part in self.parts[item]]
                if min(overlaps[2:] or overlaps) >= OVERLAP - 1e-9:
                    found[item] = max(found.get(item, (0.0,)), (score, *overlaps[:2]))
        return [(self.item_ids[item], *values) for item, values in sorted(found.items())]


def _terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(w, len(unit), 1 if k == 0 else 0) for text, answer in zip(batch["text"], batch["answer"]) for unit in units_of(words_of(text if answer is None else f"{text}\n{answer}")) for k, w in enumerate(sorted(set(unit)))]
        yield pd.DataFrame(rows, columns=["term", "length", "first"])


def indexes(items: DataFrame, item_id: str = "item_id", text: str = "text", answer: str | None = None, shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """Indexes of all items, one shard of about ``shard_bytes`` of text after the other.

    Items without a word are in no index; repeated items are indexed once.
    """
    reply = F.col(answer).cast("string") if answer else F.lit(None).cast("string")
    rows = items.select(F.col(item_id).alias("id"), texts(text).alias("text"), reply.alias("answer")).distinct()
    size = rows.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("answer"), F.lit(0))).alias("n")).first()["n"] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    dealt = write_table(rows.withColumn("shard", F.pmod(F.xxhash64("id", "text", "answer"), F.lit(shards))), "benchmark-items")
    terms = write_table(
        dealt.mapInPandas(_terms, "term string, length bigint, first int").groupBy("term").agg(F.count("*").alias("df"), F.sum("first").alias("units"), F.sum(F.col("length") * F.col("first")).alias("words")),
        "benchmark-terms",
    )
    total = terms.agg(F.sum("units").alias("units"), F.sum("words").alias("words")).first()
    for k in range(shards):
        here = dealt.filter(F.col("shard") == k)
        own = here.mapInPandas(_terms, "term string, length bigint, first int").select("term").distinct()
        frequency = {r["term"]: r["df"] for r in own.join(terms, "term").select("term", "df").collect()}
        if frequency:
            rows_here = sorted(((r["id"], r["text"], r["answer"]) for r in here.collect()), key=repr)
            yield Index.build(rows_here, frequency, total["units"], total["words"] / total["units"])


def _found(docs: DataFrame, index: Index, text: str, kind: str) -> Column:
    held = sent(docs.sparkSession, index)

    @F.pandas_udf(f"array<struct<item_id:{kind},score:double,question_overlap:double,answer_overlap:double>>")
    def find(column: pd.Series) -> pd.Series:
        names = ("item_id", "score", "question_overlap", "answer_overlap")
        return pd.Series([[dict(zip(names, m)) for m in held().matches(t)] for t in column])

    return find(texts(text))


def contaminated(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", answer: str | None = None, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(id, item_id, score, question_overlap, answer_overlap): one row for each document row and item
    that it holds.

    Null and empty texts hold nothing, items without a word are held by nothing, and a document that
    is there twice is found twice.  An empty table on either side gives no rows.
    """
    kind = items.schema[item_id].dataType.simpleString()
    parts = [
        docs.select(F.col(id_column).alias("id"), F.explode(_found(docs, index, text, kind)).alias("m")).select(F.col("id").alias(id_column), "m.*")
        for index in indexes(items, item_id, item_text, answer, shard_bytes)
    ]
    if not parts:
        return docs.select(F.col(id_column), *(F.lit(None).cast(t).alias(c) for c, t in (("item_id", kind), ("score", "double"), ("question_overlap", "double"), ("answer_overlap", "double")))).filter(F.lit(False))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", answer: str | None = None, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``docs`` without those that hold an item; same columns.  A narrow filter per index: with more
    than one, the rows left are written before the next, so that one index is held at a time."""
    kind = items.schema[item_id].dataType.simpleString()
    left = docs
    for k, index in enumerate(indexes(items, item_id, item_text, answer, shard_bytes)):
        source = write_table(left, "decontaminated") if k else left
        found = f"{own_prefix(docs)}found"
        left = source.withColumn(found, _found(source, index, text, kind)).filter(F.size(found) == 0).select(*docs.columns)
    return left
