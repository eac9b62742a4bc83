"""Duplicates: by message position, by content, and the duplicate report.

All of it is hash or sort aggregation with map-side combine, so a group of copies that holds a large
share of the rows shrinks to one row per task before the shuffle.  Nothing is ranked in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.fingerprints import content_fingerprint

POSITION = ["topic", "partition", "offset"]


def position_number() -> Column:
    """(partition, offset) as one exact number that sorts like the pair."""
    return F.col("partition").cast("decimal(38,0)") * F.lit("10000000000000000000").cast("decimal(20,0)") + F.col("offset").cast("decimal(20,0)")


def dedup_offset(df: DataFrame) -> DataFrame:
    """One row per (topic, partition, offset); copies of a position are equal by definition."""
    return df.dropDuplicates(POSITION)


def dedup_offset_stream(df: DataFrame, delay: str = "24 hours", time: str = "timestamp") -> DataFrame:
    """The same on a stream, remembering positions for ``delay``."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(POSITION)


def with_fingerprint(df: DataFrame) -> DataFrame:
    return df.withColumn("fingerprint", content_fingerprint(F.col("value")))


def dedup_content(df: DataFrame, keys: list[str]) -> DataFrame:
    """The first delivery of each content (lowest partition and offset) and the number of copies.

    ``keys`` name the scope in which contents are compared, e.g. topic and business date.
    """
    marked = with_fingerprint(df)
    rest = [c for c in marked.columns if c not in (*keys, "fingerprint")]
    best = F.min_by(F.struct(*rest), position_number())
    return (
        marked.groupBy(*keys, "fingerprint")
        .agg(best.alias("_first"), F.count("*").alias("copies"))
        .select(*keys, "fingerprint", "_first.*", "copies")
    )


def dedup_content_stream(df: DataFrame, keys: list[str], delay: str = "24 hours", time: str = "timestamp") -> DataFrame:
    return with_fingerprint(df).withWatermark(time, delay).dropDuplicatesWithinWatermark([*keys, "fingerprint"])


def deduplicated(df: DataFrame, by: str | None) -> DataFrame:
    """Envelopes without second deliveries, by position or by content within a topic; None keeps all."""
    if by is None:
        return df
    if by == "offset":
        return dedup_offset(df)
    if by == "content":
        return dedup_content(df, ["topic"]).select(*df.columns)
    raise ValueError(f"unknown kind of duplicates {by!r}")


def deduplicated_stream(df: DataFrame, by: str | None, delay: str = "24 hours") -> DataFrame:
    """The same over a stream, across batches; deliveries more than ``delay`` apart are not compared."""
    if by is None:
        return df
    if by == "offset":
        return dedup_offset_stream(df, delay)
    if by == "content":
        return dedup_content_stream(df, ["topic"], delay).select(*df.columns)
    raise ValueError(f"unknown kind of duplicates {by!r}")


def record_key(columns: list[str]) -> Column:
    """``user_<id>`` or ``order_<id>`` plus ``_<timestamp>``; empty if a row has neither."""
    pieces = []
    owner = F.lit(None).cast("string")
    for name, prefix in (("order_id", "order_"), ("user_id", "user_")):
        if name in columns:
            owner = F.when(F.col(name).isNotNull(), F.concat(F.lit(prefix), F.col(name))).otherwise(owner)
    pieces.append(F.coalesce(owner, F.lit("")))
    if "timestamp" in columns:
        pieces.append(F.coalesce(F.concat(F.lit("_"), F.col("timestamp").cast("string")), F.lit("")))
    return F.concat(*pieces)


def duplicate_report(rows: DataFrame, position: list[str]) -> DataFrame:
    """Totals, distinct keys and positions, and the verdict "at most one in a hundred"."""
    key = F.nullif(record_key(rows.columns), F.lit(""))
    counts = rows.select(key.alias("_key"), F.struct(*position).alias("_position")).agg(
        F.count("*").alias("total_messages"),
        F.count("_key").alias("_keyed"),
        F.countDistinct("_key").alias("unique_messages"),
        F.countDistinct("_position").alias("unique_offsets"),
    )
    duplicates = F.col("_keyed") - F.col("unique_messages")
    return counts.select(
        "total_messages",
        "unique_messages",
        "unique_offsets",
        duplicates.alias("duplicate_messages"),
        F.when(F.col("total_messages") > 0, duplicates / F.col("total_messages")).otherwise(F.lit(0.0)).alias("duplicate_rate"),
        (duplicates <= F.floor(F.col("total_messages") / 100)).alias("passed"),
    )
