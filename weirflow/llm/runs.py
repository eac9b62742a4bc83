"""Periodic runs: stretches of words that repeat with a small period, found with a suffix automaton.

A run is a stretch whose words equal those one period earlier, of at least ``REPEATS`` periods and
``LEAST`` words, that no neighbouring word extends; the period is the smallest one.

Each appended word is a walk from its prefix's state to the root of the suffix-link tree.  The tree is
kept as preferred paths in splay trees (link-cut access): a path holds the states whose strings ended
last at the same word, so a walk meets few paths, recolours them with the new end and yields for each
the longest string that ended there before.  If that string of length L ended d words ago and d <= L,
both together are a square of period d, and a stretch of L + d words with period d; the last end at
which a (start, period) is seen is the end of its run.

Before that, positions are dropped that cannot lie in a run: inside a run, after its first period, each
eight words stand also one period earlier.  Stretches without such repeats, or with repeats farther
away than the stretch could hold, need no automaton.  No run is lost by this (see :func:`stretches`).

Everything is inside one document, so nothing is shuffled; a hot source is many rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from weirflow.llm.common import texts, travels

REPEATS, LEAST = 3, 24
GRAM = 8  # words of the prefilter; LEAST - GRAM - (GRAM - 1) must be positive
_FACTOR = 0x9E3779B97F4A7C15

travels(__name__)


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than the white space of ASCII, as bytes."""
    return text.encode("utf-8", "surrogatepass").split()


def stretches(words: list[bytes]) -> list[tuple[int, int]]:
    """Disjoint (from, to) that hold every run whole.

    Take a run of period q and length n >= max(24, 3q).  Its positions from q on at which eight words
    still fit, c = n - q - 7 of them, each have an equal eight words at distance q, so the distance to
    the previous equal ones is at most q.  They lie in one maximal stretch of m >= c >= 9 positions with
    a previous equal, whose least distance is at most q, and q <= (c + 7) / 2 <= (m + 7) / 2.
    """
    n = len(words)
    if n < LEAST:
        return []
    grams = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    width, factor = 1, _FACTOR
    while width < GRAM:  # equal words give equal grams; the reverse is not needed
        grams = grams[:-width] * np.uint64(factor) + grams[width:]
        width, factor = 2 * width, factor * factor & 0xFFFFFFFFFFFFFFFF
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    again = ranked[1:] == ranked[:-1]
    if not again.any():
        return []
    back = np.full(len(grams) + 2, n, np.int64)  # one more on either side, without an equal
    back[order[1:][again] + 1] = (order[1:] - order[:-1])[again]
    edges = np.flatnonzero(np.diff((back < n).astype(np.int8)))
    first, last = edges[::2], edges[1::2]  # stretch of positions first .. last - 1
    size = last - first
    nearest = np.minimum.reduceat(back, np.stack([first + 1, last + 1], 1).ravel())[::2] if len(first) else first
    reach = (size + GRAM - 1) // 2
    wanted = (size >= LEAST - GRAM - (GRAM - 1)) & (nearest <= reach)
    found: list[tuple[int, int]] = []
    for a, b in zip(np.maximum(first - reach, 0)[wanted].tolist(), (last + GRAM - 1)[wanted].tolist()):
        if found and a <= found[-1][1]:
            found[-1] = (min(a, found[-1][0]), max(b, found[-1][1]))
            while len(found) > 1 and found[-1][0] <= found[-2][1]:
                a, b = found.pop()
                found[-1] = (min(a, found[-1][0]), max(b, found[-1][1]))
        else:
            found.append((a, b))
    return found


def automaton_runs(words: list[bytes]) -> dict[tuple[int, int], int]:
    """(start, period) -> end (exclusive) of every run of ``words``."""
    # States of the automaton: 0 is none, 1 the root.
    size, link, steps = [0, 0], [0, 0], [{}, {}]
    # Splay trees of the preferred paths: left is nearer to the root of the link tree.  ``up`` of a
    # tree's root is the state above the path.  ``ended`` of a tree's root is the last end of its path.
    left, right, up, ended = [0, 0], [0, 0], [0, 0], [0, 0]

    def splay(x: int) -> None:
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            low = left[p] == x
            if g and (left[g] == p or right[g] == p):
                above = up[g]
                straight = (left[g] == p) == low
                if straight:  # p over g, then x over p
                    if low:
                        c = left[g] = right[p]
                        right[p] = g
                    else:
                        c = right[g] = left[p]
                        left[p] = g
                    if c:
                        up[c] = g
                    up[g] = p
                    if low:
                        c = left[p] = right[x]
                        right[x] = p
                    else:
                        c = right[p] = left[x]
                        left[x] = p
                    if c:
                        up[c] = p
                    up[p] = x
                else:  # x over p, then x over g
                    if low:
                        c = left[p] = right[x]
                        d = right[g] = left[x]
                        right[x], left[x] = p, g
                    else:
                        c = right[p] = left[x]
                        d = left[g] = right[x]
                        left[x], right[x] = p, g
                    if c:
                        up[c] = p
                    if d:
                        up[d] = g
                    up[p] = up[g] = x
                top = g
            else:
                above, top = g, p
                if low:
                    c = left[p] = right[x]
                    right[x] = p
                else:
                    c = right[p] = left[x]
                    left[x] = p
                if c:
                    up[c] = p
                up[p] = x
            up[x] = above
            if above and left[above] == top:
                left[above] = x
            elif above and right[above] == top:
                right[above] = x
            else:  # the tree's root is x now
                ended[x] = ended[top]
                return

    def state(length: int, parent: int, out: dict) -> int:
        size.append(length)
        link.append(parent)
        steps.append(out)
        left.append(0)
        right.append(0)
        up.append(parent)
        ended.append(0)
        return len(size) - 1

    found: dict[tuple[int, int], int] = {}
    last = 1
    for end, word in enumerate(words, 1):
        new = state(end, 1, {})
        p = last
        while p and word not in steps[p]:
            steps[p][word] = new
            p = link[p]
        if p:
            q = steps[p][word]
            if size[q] != size[p] + 1:
                copy = state(size[p] + 1, link[q], steps[q].copy())
                while p and steps[p].get(word) == q:
                    steps[p][word] = copy
                    p = link[p]
                # In the link tree the copy comes right above q, on q's path.
                splay(q)
                above = left[q]
                left[copy], up[copy], left[q] = above, q, copy
                if above:
                    up[above] = copy
                link[q] = copy
                q = copy
            link[new] = up[new] = q
        last = new
        # Access: all paths from the new state to the root become one, which ends here.
        below, x = 0, new
        while x:
            splay(x)
            before = ended[x]
            deeper = right[x]
            if deeper:
                ended[deeper] = before
            right[x] = below
            if before:
                period, length = end - before, size[x]
                if length >= (REPEATS - 1) * period and length + period >= LEAST:
                    found[end - length - period, period] = end
            below, x = x, up[x]
        ended[below] = end
    return found


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    found = []
    for a, b in stretches(words):
        found += [(a + start, end - start, period) for (start, period), end in automaton_runs(words[a:b]).items()]
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that stand in any run after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    stays = np.cumsum(change[:-1]) == 0
    return [word for word, stay in zip(words, stays.tolist()) if stay]


_FOUND = StructType([*(StructField(n, ArrayType(LongType())) for n in ("starts", "lengths", "periods")), StructField("collapsed", StringType())])


@F.pandas_udf(_FOUND)
def _detect(column: pd.Series) -> pd.DataFrame:
    rows = []
    for text in column:
        words = words_of(text)
        runs = runs_of(words)
        kept = kept_words(words, runs) if runs else words
        columns = [np.array(c, np.int64) for c in zip(*runs)] if runs else [np.zeros(0, np.int64)] * 3
        rows.append((*columns, b" ".join(kept).decode("utf-8", "replace")))
    return pd.DataFrame(rows, columns=["starts", "lengths", "periods", "collapsed"])


def find_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``runs`` (array of start, length, period; by start, then period) and ``collapsed``,
    the text's words joined by one space without those that only repeat (each run keeps its first period).

    Null and empty texts, and texts of white space, have no runs and an empty ``collapsed``.  Rows with
    null ids and repeated rows each give a row; an empty table gives an empty table.  Other columns of
    ``docs`` are not read.
    """
    found = docs.select(F.col(id_column).alias("id"), _detect(texts(text)).alias("found"))
    runs = F.transform(
        F.arrays_zip("found.starts", "found.lengths", "found.periods"),
        lambda r: F.struct(r["starts"].alias("start"), r["lengths"].alias("length"), r["periods"].alias("period")),
    )
    return found.select(F.col("id").alias(id_column), runs.alias("runs"), F.col("found.collapsed").alias("collapsed"))


def strongest(runs: str) -> Column:
    """Of an array of runs the one with the greatest length / period; ties: smallest start, then period."""
    better = lambda a, b: (
        a["length"] * b["period"] > b["length"] * a["period"]
    ) | (
        (a["length"] * b["period"] == b["length"] * a["period"])
        & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"])))
    )
    return F.aggregate(F.col(runs), F.get(F.col(runs), F.lit(0)), lambda best, run: F.when(better(run, best), run).otherwise(best))


# --- the query's fixture and digests --------------------------------------------------------------


def repeated_tail(text: str, mark: int) -> str:
    """A text whose words from ``a`` on are made periodic, if ``mark`` is divisible by ten."""
    if mark % 10:
        return text
    words = words_of(text)
    n, g = len(words), mark // 10
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)]).decode("utf-8", "replace")


@F.pandas_udf(StringType())
def _planted(column: pd.Series, marks: pd.Series) -> pd.Series:
    return pd.Series([repeated_tail(text, int(mark)) for text, mark in zip(column, marks)], dtype=object)


def run_report(docs: DataFrame) -> DataFrame:
    """The digests of op13: documents whose crc32 of the id is divisible by ten get a periodic tail first
    (a null id has none), then the runs of every whole text are found."""
    mark = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(1))
    source = docs.select("doc_id", _planted(texts("text"), mark).alias("text"))
    best = F.col("best")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return find_runs(source).withColumn("best", strongest("runs")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
