"""Batch numbers: which write of a destination a message belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.config import DEFAULT_TOPICS, TopicConfig
from weirflow.functions.ordered import running_sum
from weirflow.operators.route import route

# A chunk covers this many offsets of one partition, hence at most this many distinct messages.
OFFSETS_PER_CHUNK = 100_000


def batch_assignment(df: DataFrame, topics: tuple[TopicConfig, ...] = DEFAULT_TOPICS, chunk: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """Number the messages of each destination by (partition, offset) and cut after ``batch_size``.

    Offsets are unique within a partition, so counting by offset chunks gives bounded groups however
    large a destination is; a second delivery of an offset belongs to the batch of the first.
    """
    routed = route(df.select("topic", "partition", "offset"), topics).filter(F.col("route_error").isNull())
    spots = routed.select(
        F.concat_ws("_", "topic", "table_name").alias("destination"), "batch_size", "partition", "offset"
    ).distinct()
    chunked = spots.withColumn("offset_chunk", F.floor(F.col("offset") / chunk))
    numbered = running_sum(
        chunked, ["destination"], ["offset"], F.lit(1), "position", chunk=["partition", "offset_chunk"]
    )
    return numbered.select(
        "destination",
        "partition",
        "offset",
        F.floor((F.col("position") - 1) / F.col("batch_size")).cast("bigint").alias("batch_no"),
    )
