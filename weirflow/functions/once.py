"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` for expensive columns that later filters test.

    A filter on an ordinary computed column is pushed below the projection with the whole expression
    copied into it, so parsing or rule chains would run twice, and copies of copies make plans huge.
    Passing the columns through ``inline`` of a one-element array stops that, inside the same stage
    and without a shuffle; filters on the other columns still reach the scan.
    """
    packed = df.withColumn("_packed", F.struct(*[c.alias(n) for n, c in columns.items()]))
    keep = [c for c in df.columns if c not in columns]
    return packed.select(*keep, F.inline(F.array("_packed")))
