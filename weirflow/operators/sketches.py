"""Summaries that merge: quantiles and distinct counts of any period from those of short windows.

A window's rows are read once and leave a sketch of bounded size.  Longer windows, other groupings and
comparisons between periods are made of sketches alone, so the log need not be kept or read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_K = 400  # quantile ranks are right to about 0.7 percent of the rows, at 99 percent confidence
THETA_LG = 14  # distinct counts have a standard error of 1 / sqrt(2 ^ 14), 0.8 percent


# ---- quantiles ------------------------------------------------------------------------------


def quantile_sketches(df: DataFrame, keys: list[str], window: Column, value: str, k: int = KLL_K) -> DataFrame:
    """(keys, window_start, n, sketch): a KLL sketch of ``value`` for each key and window; null values do not count."""
    number = F.col(value).cast("double")
    return df.groupBy(*keys, window.alias("window_start")).agg(F.count(number).alias("n"), F.kll_sketch_agg_double(number, k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: list[str], window: Column | None = None, k: int = KLL_K) -> DataFrame:
    """The sketches of coarser groups: fewer keys, longer windows, or both (no window: all of them)."""
    groups = [*keys, *([window.alias("window_start")] if window is not None else [])]
    return sketches.groupBy(*groups).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles_of(sketches: DataFrame, quantiles: tuple[float, ...]) -> DataFrame:
    """One row for each sketch and quantile: the other columns, ``quantile`` and ``value``."""
    rest = [c for c in sketches.columns if c != "sketch"]
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    found = F.arrays_zip(wanted.alias("quantile"), F.kll_sketch_get_quantile_double("sketch", wanted).alias("value"))
    return sketches.filter("n > 0").select(*rest, F.inline(found))


# ---- distinct counts ------------------------------------------------------------------------


def distinct_sketches(df: DataFrame, keys: list[str], window: Column, value: str, lg: int = THETA_LG) -> DataFrame:
    """(keys, window_start, rows, sketch): a theta sketch of the distinct ``value`` for each key and window."""
    text = F.col(value).cast("string")
    return df.groupBy(*keys, window.alias("window_start")).agg(F.count("*").alias("rows"), F.theta_sketch_agg(text, lg).alias("sketch"))


def union_of(sketches: DataFrame, keys: list[str], window: Column | None = None, lg: int = THETA_LG) -> DataFrame:
    """The sketches of coarser groups."""
    groups = [*keys, *([window.alias("window_start")] if window is not None else [])]
    return sketches.groupBy(*groups).agg(F.sum("rows").alias("rows"), F.theta_union_agg("sketch", lg).alias("sketch"))


def overlap(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: distinct values in ``a``, in ``b`` and in both, estimated."""
    joined = a.select(*keys, F.col("sketch").alias("_a")).join(b.select(*keys, F.col("sketch").alias("_b")), keys)
    both = F.theta_sketch_estimate(F.theta_intersection("_a", "_b"))
    return joined.select(*keys, F.theta_sketch_estimate("_a").alias("first"), F.theta_sketch_estimate("_b").alias("second"), both.alias("both"))
