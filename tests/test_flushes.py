import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from weirflow.operators.flushes import flush_boundaries

T0 = dt.datetime(2024, 1, 1)


def plain(rows, size, interval_ms):
    """The writer itself: buffers, a clock that is the time of the row, all buffers flushed at once."""
    out, buffers, last = [], {}, None
    held = []
    for at, _, key in sorted(rows):
        last = at if last is None else last
        buffers[key] = buffers.get(key, 0) + 1
        held.append(at)
        cause = "size" if buffers[key] >= size else "time" if at - last >= interval_ms else None
        if cause:
            out.append((len(out), len(held), cause, held[0], held[-1]))
            buffers, held, last = {}, [], at
    if held:
        out.append((len(out), len(held), "stop", held[0], held[-1]))
    return out


def flushed(spark, rows, size, interval_ms, rows_per_chunk):
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(T0 + dt.timedelta(milliseconds=a), n, k) for a, n, k in rows], "ts timestamp, n long, k string")
    got = flush_boundaries(df.repartition(3), F.col("k"), "ts", ["n"], size, interval_ms, rows_per_chunk)
    return sorted((r.flush_no, r.rows, r.cause, r.first_ms - base, r.last_ms - base) for r in got.collect())


@pytest.mark.parametrize("seed,size,interval_ms,rows_per_chunk", [(1, 5, 400, 50), (2, 3, 10**9, 7), (3, 10**6, 300, 20), (4, 1, 10, 16), (5, 40, 900, 10**6)])
def test_flushes_equal_the_writer(spark, seed, size, interval_ms, rows_per_chunk):
    rng = random.Random(seed)
    rows, at = [], 0
    for n in range(240):
        at += rng.choice([0, 0, 1, 5, 60, 700 if rng.random() < 0.1 else 3])
        rows.append((at, n, "hot" if rng.random() < 0.5 else rng.choice("abcde")))
    want = plain(rows, size, interval_ms)
    assert flushed(spark, rows, size, interval_ms, rows_per_chunk) == want
    assert len(want) > 1


def test_one_buffer_with_all_rows_over_many_chunks(spark):
    rows = [(n // 7, n, "hot") for n in range(500)]
    assert flushed(spark, rows, 9, 10**6, 25) == plain(rows, 9, 10**6)


def test_a_single_row_and_none(spark):
    assert flushed(spark, [(3, 0, "a")], 2, 50, 10) == [(0, 1, "stop", 3, 3)]
    assert flushed(spark, [(3, 0, "a")], 1, 50, 10) == [(0, 1, "size", 3, 3)]
    assert flushed(spark, [], 2, 50, 10) == []
    assert flushed(spark, [(0, 0, None), (0, 1, None), (0, 2, "a")], 2, 50, 10) == [(0, 2, "size", 0, 0), (1, 1, "stop", 0, 0)]
