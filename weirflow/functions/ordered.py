"""Running totals over an order, without putting a whole key into one task.

A plain window ``partitionBy(key).orderBy(time)`` sends every row of a key to one task, so a key
with a third of all rows decides the run time.  Here the rows are range-partitioned by (key, order):
a heavy key spreads over many *chunks*.  Totals are taken per chunk, carried forward over the small
table of chunks, and added to the running total inside each chunk.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.session import reliable_checkpoint

CHUNK = "chunk"
ROWS_PER_CHUNK = 250_000


def range_chunks(df: DataFrame, order: list[str], chunks: int | None = None, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add ``chunk``: rows of a lower chunk come before those of a higher one in ``order``.

    Chunks have about ``rows_per_chunk`` rows, so that what is done inside one fits a task at any size
    of input.  The placement is written to the shared folder, because the chunk borders come from a
    sample and must be the same for every later pass.  Select only the needed columns first.
    """
    n = chunks or max(1, math.ceil(df.count() / rows_per_chunk))
    placed = df.repartitionByRange(n, *order).withColumn(CHUNK, F.spark_partition_id())
    return reliable_checkpoint(placed)


def running(
    placed: DataFrame, keys: list[str], order: list[str], value: Column, out: str, total=F.sum, chunk: list[str] = (CHUNK,)
) -> DataFrame:
    """Inclusive running total (``F.sum``, ``F.min`` or ``F.max``) of ``value`` per key in ``order``; null where
    no row so far has a value.

    ``placed`` comes from :func:`range_chunks`, or has ``chunk`` columns of its own that sort like the
    order and bound the rows of one (key, chunk).  Keys must not be NULL.
    """
    join = {F.sum: lambda a, b: F.coalesce(a + b, a, b), F.min: F.least, F.max: F.greatest}[total]
    spot = [*keys, *chunk]
    valued = placed.withColumn("_v", value)
    totals = valued.groupBy(*spot).agg(total("_v").alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*spot, total("_total").over(earlier).alias("_carried"))
    inside = Window.partitionBy(*spot).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        valued.withColumn("_inside", total("_v").over(inside))
        .join(carried, spot)
        .withColumn(out, join(F.col("_carried"), F.col("_inside")))
        .drop("_v", "_inside", "_carried")
    )


def running_sum(
    placed: DataFrame, keys: list[str], order: list[str], value: Column, out: str, chunk: list[str] = (CHUNK,)
) -> DataFrame:
    """:func:`running` for sums."""
    return running(placed, keys, order, value, out, F.sum, chunk)
