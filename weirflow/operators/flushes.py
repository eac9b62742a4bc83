"""Flush boundaries: where a writer that buffers by destination key empties all its buffers.

All buffers are flushed together once any of them holds ``size`` rows, or once ``interval_ms`` have
passed since the last flush; what is left goes out when the writer stops.  So each cut depends on the
cut before it.  Seen from a cut at row i the next one is known without the cuts before i:

* by size, the least row r > i that is the ``size``-th of its key after i, a running minimum from the end;
* by time, the first row at least ``interval_ms`` after row i, a count of rows.

These pointers never cross, so the cuts are the chain of pointers from the first row.  Rows lie in chunks
of their number.  A chunk turns the rows at which the chain can enter it (those up to the first pointer)
into the rows at which it leaves, all chunks at once; pointer doubling over these few entries finds
where the chain does enter, in as many rounds as the number of chunks has binary digits; and the
chunks then walk from there.  No task sees more than a chunk, whatever the size of a buffer's key.
"""

from __future__ import annotations

import sys
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.ordered import CHUNK, ROWS_PER_CHUNK, range_chunks, running
from weirflow.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE, TIME, STOP = "size", "time", "stop"
_END = np.iinfo(np.int64).max  # no further cut


def numbered(rows: DataFrame, order: list[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``rows`` with ``pos``, their number in ``order`` from 1.  Rows that are equal in ``order`` are numbered
    in some order, the same one for every later pass."""
    placed = range_chunks(rows, order, rows_per_chunk=rows_per_chunk)
    counted = running(placed.withColumn("all", F.lit(0)), ["all"], [*order], F.lit(1), "pos", total=F.sum)
    return stored(counted.drop("all", CHUNK), "flush-rows")


def pointers(rows: DataFrame, size: int, interval_ms: int, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(pos, at_ms, next, by_size): the next cut after a cut at each row, or the greatest long; row 0 is the start.

    ``rows`` is (pos, at_ms, key), numbered by time.
    """
    by_number = lambda df: df.withColumn(CHUNK, F.floor(F.col("pos") / rows_per_chunk))
    # The row that fills a buffer that is empty before row p: size - 1 rows later in its key.
    chunked = by_number(rows.select("pos", F.coalesce("key", F.lit("")).alias("key")))
    ranked = stored(running(chunked, ["key"], ["pos"], F.lit(1), "rank", total=F.sum).select("key", "rank", "pos"), "flush-ranks")
    filled = ranked.join(ranked.select("key", (F.col("rank") - (size - 1)).alias("rank"), F.col("pos").alias("full")), ["key", "rank"], "left")
    backwards = by_number(filled.select("pos", "full")).withColumns({"all": F.lit(0), "back": -F.col(CHUNK), "behind": -F.col("pos")})
    earliest = running(backwards, ["all"], ["behind"], F.col("full"), "by_size", total=F.min, chunk=["back"])
    by_size = earliest.select((F.col("pos") - 1).alias("pos"), "by_size")  # rows after i are those from i + 1 on

    # Rows before the time at which a flush is due, for each row.
    start = rows.agg(F.min("at_ms").alias("at_ms")).select(F.lit(0).cast("bigint").alias("pos"), "at_ms").filter("at_ms is not null")
    cuts = start.union(rows.select("pos", "at_ms"))
    probes = cuts.select((F.col("at_ms") + interval_ms).alias("at_ms"), F.lit(0).alias("is_row"), "pos")
    both = probes.union(rows.select("at_ms", F.lit(1), "pos")).withColumn("all", F.lit(0))
    placed = range_chunks(both, ["at_ms", "is_row", "pos"], rows_per_chunk=rows_per_chunk)
    counted = running(placed, ["all"], ["at_ms", "is_row", "pos"], F.col("is_row"), "before", total=F.sum).filter("is_row = 0")
    rows_in_all = rows.agg(F.count("*").alias("n"))
    due = F.when(F.col("before") < F.col("n"), F.greatest(F.col("before"), F.col("pos")) + 1)
    by_time = counted.crossJoin(F.broadcast(rows_in_all)).select("pos", due.alias("by_time"))  # one row beside each
    found = cuts.join(by_size, "pos", "left").join(by_time, "pos", "left")
    by_time_only = F.when(F.col("by_time") <= F.col("n"), F.col("by_time"))
    found = found.crossJoin(F.broadcast(rows_in_all)).withColumn("by_time", by_time_only)
    first = F.coalesce(F.least("by_size", "by_time"), F.lit(int(_END)))
    return stored(found.select("pos", "at_ms", first.alias("next"), (F.col("by_size") == first).alias("by_size")), "flush-pointers")


def _leaving(pos: np.ndarray, nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a chunk the first cut behind the chunk on its chain, and how many cuts lead to it."""
    end = pos[-1]
    out, hops = nxt.copy(), np.ones(len(pos), np.int64)
    inside = out <= end
    while inside.any():  # doubling inside the chunk
        at = out[inside] - pos[0]
        hops[inside] += hops[at]
        out[inside] = out[at]
        inside = out <= end
    return out, hops


def _entries(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos")
    pos, nxt = pdf["pos"].to_numpy(np.int64), pdf["next"].to_numpy(np.int64)
    out, hops = _leaving(pos, nxt)
    # Pointers never cross, so a chain that comes from before the first row enters at its pointer at the latest.
    can = (pos <= nxt[0]) & (out < _END)
    return pd.DataFrame({"pos": pos[can], "leaves": out[can], "cuts": hops[can]})


def _walk(key: tuple[Any, ...], rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
    found = []
    if len(entry) and len(rows):
        rows = rows.sort_values("pos")
        pos, nxt, by_size = rows["pos"].to_numpy(np.int64), rows["next"].to_numpy(np.int64), rows["by_size"].to_numpy(bool)
        at, number = int(entry["pos"].iloc[0]), int(entry["cuts"].iloc[0])
        while at <= pos[-1]:
            to = int(nxt[at - pos[0]])
            if to == _END:
                found.append((number, at, None, STOP))
                break
            found.append((number, at, to, SIZE if by_size[at - pos[0]] else TIME))
            at, number = to, number + 1
    return pd.DataFrame(found, columns=["flush_no", "after", "last", "cause"]).astype({"last": "Int64"})


def chain(found: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(flush_no, after, last, cause) from pointers: flush ``flush_no`` holds the rows after row ``after`` up to
    row ``last`` (null: to the end)."""
    chunked = found.withColumn(CHUNK, F.floor(F.col("pos") / rows_per_chunk))
    jumps = stored(chunked.groupBy(CHUNK).applyInPandas(_entries, "pos bigint, leaves bigint, cuts bigint"), "flush-jumps")
    entered = found.filter("pos = 0").select("pos", F.lit(0).cast("bigint").alias("cuts"))
    while not jumps.isEmpty():
        onward = entered.withColumnRenamed("cuts", "so_far").join(jumps, "pos").select(F.col("leaves").alias("pos"), (F.col("so_far") + F.col("cuts")).alias("cuts"))
        entered = stored(entered.union(onward).distinct(), "flush-entered")
        further = jumps.select(F.col("pos").alias("leaves"), F.col("leaves").alias("to"), F.col("cuts").alias("more"))
        jumps = stored(jumps.join(further, "leaves").select("pos", F.col("to").alias("leaves"), (F.col("cuts") + F.col("more")).alias("cuts")), "flush-jumps")
    entries = entered.withColumn(CHUNK, F.floor(F.col("pos") / rows_per_chunk))
    return chunked.groupBy(CHUNK).cogroup(entries.groupBy(CHUNK)).applyInPandas(_walk, "flush_no bigint, after bigint, last bigint, cause string")


def flush_boundaries(messages: DataFrame, key: Column, time: str, order: list[str], size: int, interval_ms: int, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(flush_no, rows, cause, first_ms, last_ms) of each flush of one writer, from 0.

    ``messages`` arrive by ``time`` (ties: ``order``); ``key`` names the buffer of each.  A null time is
    the earliest; a null key is a buffer of its own with the empty key.  The first interval begins with the first
    message.  If a row fills a buffer and the interval is over too, the cause is the size.  No
    messages, no flush.
    """
    named = messages.select(F.unix_millis(F.col(time).cast("timestamp")).alias("at_ms"), *order, key.cast("string").alias("key"))
    earliest = named.agg(F.min("at_ms").alias("e"))
    named = named.crossJoin(F.broadcast(earliest)).withColumn("at_ms", F.coalesce("at_ms", "e", F.lit(0))).drop("e")
    rows = numbered(named, ["at_ms", *order], rows_per_chunk)
    found = pointers(rows.select("pos", "at_ms", "key"), size, interval_ms, rows_per_chunk)
    cuts = chain(found, rows_per_chunk)
    all_ = rows.agg(F.max("pos").alias("n"), F.max("at_ms").alias("end_ms"))
    closed = cuts.crossJoin(F.broadcast(all_)).withColumn("last", F.coalesce("last", "n")).filter("last > after")
    times = found.select(F.col("pos").alias("last"), F.col("at_ms").alias("last_ms"))
    firsts = found.select((F.col("pos") - 1).alias("after"), F.col("at_ms").alias("first_ms"))
    return closed.join(times, "last").join(firsts, "after").select("flush_no", (F.col("last") - F.col("after")).alias("rows"), "cause", "first_ms", "last_ms")
