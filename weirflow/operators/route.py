"""Routing by topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.config import DEFAULT_TOPICS, TopicConfig, topic_table
from weirflow.functions.sides import small_side


def route(df: DataFrame, topics: tuple[TopicConfig, ...] = DEFAULT_TOPICS) -> DataFrame:
    """Add the settings of the topic; unknown topics keep NULLs and get ``route_error``.

    Any number of topics: up to ``SMALL_ROWS`` their table goes to the messages, so that these stay where they are.
    """
    settings = topic_table(df.sparkSession, topics)
    return df.join(small_side(settings, len(topics)), "topic", "left").withColumn(
        "route_error",
        F.when(F.col("config_name").isNull(), F.concat(F.lit("No configuration found for topic: "), F.coalesce("topic", F.lit("null")))),
    )
