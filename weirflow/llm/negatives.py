"""Hard negatives by a secondary sort: pair scores as (anchor, descending score, id) keys.

Anchors are a stated query set; they meet all rows in blocks.  They are sent to the tasks in chunks of a
bounded number of bytes, and the rows do not move: each task multiplies its rows, some thousands at a
time, with the anchors of the chunk.  What leaves a task is what can still be wanted of its rows, its
best positives of each anchor and its best negatives of each window, in fixed-size tables beside the
scores, so that an anchor gives a bounded number of keys to the shuffle from each task, however many
rows its label has.

A key packs (anchor, descending score, kind, id) into bytes that sort as they are.  The shuffle deals
keys by anchor and sorts within partitions (``repartition`` and ``sortWithinPartitions``, which is
Spark's repartitionAndSortWithinPartitions for tables), and an iterator over the sorted keys opens a
window at each positive and emits each negative into the windows that it lies in.  It holds one anchor's
open windows, never an anchor's rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import travels, write_table
from weirflow.session import scratch_path

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
CHUNK_BYTES = 32 << 20  # of anchors sent to the tasks at a time
BLOCK = 2048  # rows multiplied with the anchors at a time
TILE = 512  # anchors in one matrix of scores
EXACT = 1 << 50  # sums below this are exact in doubles and fit a ranking key beside a row number
NONE = -(1 << 63)
KEY_BYTES = 25

travels(__name__)


# --- blocks of scores -----------------------------------------------------------------------------


def matrix(vectors: Iterable, width: int) -> np.ndarray:
    """Integer vectors of one length as the lines of a matrix."""
    lines = [np.asarray(v, np.int64) for v in vectors]
    return np.array(lines, dtype=np.int64).reshape(len(lines), width)


def scores_of(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond the range of a long the nearest long (but for the least one, which
    means none)."""
    top = lambda m: float(np.abs(m.astype(np.float64)).max(initial=0))
    if top(anchors) * top(rows) * max(1, rows.shape[1]) < EXACT:
        return (anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    sums = anchors.astype(object) @ rows.T.astype(object)
    return np.clip(sums, NONE + 1, (1 << 63) - 1).astype(np.int64) if rows.shape[1] else np.zeros(sums.shape, np.int64)


def best_of(scores: np.ndarray, wanted: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per line of ``scores`` the ``n`` greatest wanted ones and their ids, best first, ties by smaller
    id; the columns are in the order of ids.  Places that stay empty have the score NONE."""
    width = scores.shape[1]
    if width > n and np.abs(scores).max(initial=0) < EXACT:
        keys = np.where(wanted, scores * width + (width - 1 - np.arange(width)), NONE)
        keys = -np.sort(-np.partition(keys, width - n, axis=1)[:, width - n :], axis=1)
        # A wanted key is never so small: NONE divided by the width is beyond EXACT.
        places = np.where(keys == NONE, 0, width - 1 - np.mod(keys, width))
        return np.where(keys == NONE, NONE, np.floor_divide(keys, width)), ids[places]
    masked = np.where(wanted, scores, NONE)
    order = np.argsort(np.where(masked == NONE, np.iinfo(np.int64).max, -(masked + 1)), axis=1, kind="stable")[:, :n]
    return np.take_along_axis(masked, order, 1), ids[order]


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The best of two tables of (score, id) along the last axis, as many as ``a`` has."""
    scores, ids = np.concatenate([a[0], b[0]], -1), np.concatenate([a[1], b[1]], -1)
    order = np.lexsort((ids, np.where(scores == NONE, np.iinfo(np.int64).max, -(scores + 1))), axis=-1)[..., : a[0].shape[-1]]
    return np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)


def empty(*shape: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full(shape, NONE, np.int64), np.zeros(shape, np.int64)


# --- keys -----------------------------------------------------------------------------------------


def packed(anchor: np.ndarray, score: np.ndarray, kind: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """Keys whose bytes sort by anchor, descending score, kind (0 positive, 1 negative), id."""
    key = np.empty((len(anchor), KEY_BYTES), np.uint8)
    flip = np.uint64(1 << 63)
    key[:, 0:8] = anchor.astype(">u8").view(np.uint8).reshape(-1, 8)
    key[:, 8:16] = (~(score.view(np.uint64) ^ flip)).astype(">u8").view(np.uint8).reshape(-1, 8)
    key[:, 16] = kind
    key[:, 17:25] = (ids.view(np.uint64) ^ flip).astype(">u8").view(np.uint8).reshape(-1, 8)
    whole = key.tobytes()
    return [whole[k : k + KEY_BYTES] for k in range(0, len(whole), KEY_BYTES)]


def unpacked(keys: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    key = np.frombuffer(b"".join(map(bytes, keys)), np.uint8).reshape(-1, KEY_BYTES)
    part = lambda a: np.ascontiguousarray(key[:, a : a + 8]).view(">u8").ravel().astype(np.uint64)
    flip = np.uint64(1 << 63)
    return part(0).astype(np.int64), (~part(8) ^ flip).view(np.int64), key[:, 16].astype(np.int64), (part(17) ^ flip).view(np.int64)


def in_order(keys: DataFrame) -> DataFrame:
    """(anchor, key) dealt by anchor and sorted by key within partitions."""
    return keys.repartition("anchor").sortWithinPartitions("key")


# --- what tasks do --------------------------------------------------------------------------------


def _blocks(batches: Iterable[pd.DataFrame], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of ``BLOCK`` rows, in the order of ids."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        while n >= BLOCK:
            whole = pd.concat(held)
            yield _block(whole.iloc[:BLOCK], width)
            held, n = [whole.iloc[BLOCK:]], n - BLOCK
    if n:
        yield _block(pd.concat(held), width)


def _block(rows: pd.DataFrame, width: int):
    rows = rows.sort_values("id", kind="stable")
    return rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), matrix(rows["vector"], width)


def _tiles(chunk: tuple, ids: np.ndarray, vectors: np.ndarray):
    """(slice of anchors, scores, which pairs are an anchor with itself)."""
    a_ids, _, a_vectors = chunk
    for k in range(0, len(a_ids), TILE):
        part = slice(k, k + TILE)
        own = a_ids[part][:, None] == ids[None, :]
        for i, j in zip(*np.nonzero(own)):  # another row under the same id is another row
            own[i, j] = (a_vectors[part][i] == vectors[j]).all()
        yield part, scores_of(a_vectors[part], vectors), own


def _positives(chunk, width: int, first: int, n: int):
    """Per anchor the best ``n`` other rows of its label among the task's rows, as keys."""

    def run(batches):
        ids, labels, vectors = chunk.value
        best = empty(len(ids), n)
        for row_ids, row_labels, row_vectors in _blocks(batches, width):
            for part, scores, own in _tiles(chunk.value, row_ids, row_vectors):
                same = (labels[part][:, None] == row_labels[None, :]) & ~own
                found = merged((best[0][part], best[1][part]), best_of(scores, same, row_ids, n))
                best[0][part], best[1][part] = found
        at, place = np.nonzero(best[0] != NONE)
        yield pd.DataFrame({"anchor": at + first, "key": packed(at + first, best[0][at, place], np.zeros(len(at), np.int64), best[1][at, place])})

    return run


def _negatives(chunk, floors, ceilings, width: int, first: int, n: int):
    """Per anchor and window the best ``n`` rows of other labels among the task's rows, as keys."""

    def run(batches):
        ids, labels, vectors = chunk.value
        low, high = floors.value, ceilings.value
        best = empty(len(ids), low.shape[1], n)
        for row_ids, row_labels, row_vectors in _blocks(batches, width):
            for part, scores, _ in _tiles(chunk.value, row_ids, row_vectors):
                other = labels[part][:, None] != row_labels[None, :]
                for w in range(low.shape[1]):
                    inside = other & (scores >= low[part, w][:, None]) & (scores <= high[part, w][:, None])
                    best[0][part, w], best[1][part, w] = merged((best[0][part, w], best[1][part, w]), best_of(scores, inside, row_ids, n))
        at, window, place = np.nonzero(best[0] != NONE)
        scores, found = best[0][at, window, place], best[1][at, window, place]
        # A row may lie in several windows; rows that differ under one id are told apart by their place.
        listed = pd.DataFrame({"anchor": at, "window": window, "score": scores, "id": found})
        listed["copy"] = listed.groupby(["anchor", "window", "score", "id"]).cumcount()
        listed = listed.drop_duplicates(["anchor", "score", "id", "copy"])
        at = listed["anchor"].to_numpy(np.int64) + first
        yield pd.DataFrame({"anchor": at, "key": packed(at, listed["score"].to_numpy(np.int64), np.ones(len(listed), np.int64), listed["id"].to_numpy(np.int64))})

    return run


def _first_of_each(n: int):
    """Of sorted keys the first ``n`` of each anchor."""

    def run(batches):
        current, seen = None, 0
        for batch in batches:
            anchors, scores, _, ids = unpacked(batch["key"])
            stay = []
            for k, anchor in enumerate(anchors.tolist()):
                if anchor != current:
                    current, seen = anchor, 0
                seen += 1
                if seen <= n:
                    stay.append(k)
            yield pd.DataFrame({"anchor": anchors[stay], "score": scores[stay], "id": ids[stay]})

    return run


def _windows(n: int, low: int, high: int):
    """Over sorted keys: a positive opens a window, a negative goes to the open windows that it lies in."""

    def run(batches):
        current, opened = None, []  # a window: score, id, rows given
        for batch in batches:
            out = []
            for anchor, score, kind, own in zip(*(c.tolist() for c in unpacked(batch["key"]))):
                if anchor != current:
                    current, opened = anchor, []
                if kind == 0:
                    opened.append([score, own, 0])
                    continue
                for window in opened:
                    positive = window[0]
                    if window[2] < n and low * positive <= 100 * score <= high * positive:
                        window[2] += 1
                        out.append((anchor, window[1], window[2], own, positive, score))
            yield pd.DataFrame(out, columns=["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


# --- the operator ---------------------------------------------------------------------------------

_KEYS = "anchor long, key binary"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """(id, label, vector of longs) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor is a row for which ``anchors`` holds.  Its positives are the ``positives`` other rows of its
    label with the greatest inner product; for each of them the first ``negatives`` rows of other labels
    are given whose product is ``low`` to ``high`` percent of the positive's.  Greater scores come first,
    ties by smaller id, also if the ids repeat.

    Rows with a null id, label or vector, or a null component, take no part.  Rows that are there
    more than once count once; different rows under one id are different rows.  Only vectors of one length
    are compared.  Products beyond the range of a long count as the nearest long.  An empty table, a
    table of one label, and anchors without positives give no rows.
    """
    spark = rows.sparkSession
    whole = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"))
    whole = whole.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    kept = write_table(whole.distinct().withColumn("queried", F.coalesce(anchors, F.lit(False))), "negatives-rows")
    sizes = kept.groupBy(F.size("vector").alias("width")).agg(F.count_if("queried").alias("n")).filter("n > 0").orderBy("width").collect()  # one row a vector length
    keys_path, names_path, first = scratch_path(spark, "negatives-keys"), scratch_path(spark, "negatives-names"), 0
    for width, n in sizes:
        alike = kept.filter(F.size("vector") == width)
        parts = -(-n * max(1, width) * 8 // chunk_bytes)
        for part in range(parts):
            # Chunks are cut by a hash of the row, so a chunk has n / parts anchors or a few more.
            own = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(parts)) == part
            chosen = alike.filter(F.col("queried") & own).select("id", "label", "vector").toPandas()
            if chosen.empty:
                continue
            chosen = chosen.sort_values("id", kind="stable")
            chunk = spark.sparkContext.broadcast((chosen["id"].to_numpy(np.int64), chosen["label"].to_numpy(np.int64), matrix(chosen["vector"], width)))
            data = alike.select("id", "label", "vector")
            near = in_order(data.mapInPandas(_positives(chunk, width, first, positives), _KEYS))
            near = near.select("key").mapInPandas(_first_of_each(positives), "anchor long, score long, id long").toPandas()
            near = near.sort_values(["anchor", "score", "id"], ascending=[True, False, True])
            at = near["anchor"].to_numpy(np.int64) - first
            score, place = near["score"].to_numpy(np.int64), near.groupby("anchor").cumcount().to_numpy(np.int64)
            floors, ceilings = np.ones((len(chosen), positives), np.int64), np.zeros((len(chosen), positives), np.int64)  # no window
            floors[at, place] = [-(-low * s // 100) for s in score.tolist()]
            ceilings[at, place] = [high * s // 100 for s in score.tolist()]
            sent = spark.sparkContext.broadcast(floors), spark.sparkContext.broadcast(ceilings)
            opening = pd.DataFrame({"anchor": near["anchor"], "key": packed(at + first, score, np.zeros(len(at), np.int64), near["id"].to_numpy(np.int64))})
            data.mapInPandas(_negatives(chunk, *sent, width, first, negatives), _KEYS).write.mode("append").parquet(keys_path)
            spark.createDataFrame(opening, _KEYS).write.mode("append").parquet(keys_path)
            names = pd.DataFrame({"anchor": np.arange(first, first + len(chosen)), "anchor_id": chosen["id"].to_numpy(np.int64)})
            spark.createDataFrame(names, "anchor long, anchor_id long").write.mode("append").parquet(names_path)
            for variable in (chunk, *sent):
                variable.unpersist()
            first += len(chosen)
    if not first:
        return spark.createDataFrame([], _RESULT)
    keys = spark.read.schema(_KEYS).parquet(keys_path)
    names = spark.read.schema("anchor long, anchor_id long").parquet(names_path)
    found = in_order(keys).select("key").mapInPandas(_windows(negatives, low, high), _RESULT.replace("anchor_id", "anchor", 1))
    return found.join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mining_report(embeddings: DataFrame) -> DataFrame:
    """The contract of op12: every seventh id has the next label, components are floor(256 x), anchors are
    the ids divisible by 100; rows with a component that is null, NaN or infinite take no part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = embeddings.filter(finite & F.col("label").isNotNull()).select(F.col("vec_id").alias("id"), label.alias("label"), vector.alias("vector"))
    return hard_negatives(rows, F.col("id") % 100 == 0)
