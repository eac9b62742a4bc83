"""Sides of joins whose size the driver knows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 20_000  # rows of settings, below 1 KB each: at most 20 MB on an executor


def small_side(side: DataFrame, rows: int) -> DataFrame:
    """``side``, made by the driver from ``rows`` rows: sent to the other side's tasks up to ``SMALL_ROWS``
    rows, so that messages need no shuffle on a few frequent keys; joined by a shuffle beyond."""
    return F.broadcast(side) if rows <= SMALL_ROWS else side
