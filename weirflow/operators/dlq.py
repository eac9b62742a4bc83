"""Dead letters: the envelope of a rejected message, counts, and reprocessing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.config import TopicConfig
from weirflow.functions.keys import dlq_topic
from weirflow.functions.times import as_of_timestamp
from weirflow.operators.parse import parse
from weirflow.operators.rules import validate

DLQ_VERSION = "1.0"


def dlq_envelope(rejects: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Rejected messages (``reject_rule`` set) as dead letters."""
    return rejects.select(
        dlq_topic(F.col("topic")).alias("dlq_topic"),
        F.col("topic").alias("original_topic"),
        F.col("partition").alias("original_partition"),
        F.col("offset").alias("original_offset"),
        F.col("key").alias("original_key"),
        F.col("value").alias("original_value"),
        F.col("timestamp").alias("original_timestamp"),
        F.col("reject_rule").alias("error_reason"),
        F.coalesce("reject_reason", F.lit("Unknown error")).alias("error_message"),
        F.when(F.col("reject_rule") == "parse", F.lit("ParseError"))
        .when(F.col("reject_rule") == "route", F.lit("RoutingError"))
        .otherwise(F.lit("ValidationError"))
        .alias("error_class"),
        as_of_timestamp(as_of).alias("dlq_timestamp"),
        F.lit(DLQ_VERSION).alias("dlq_version"),
    )


def dlq_kafka_rows(letters: DataFrame) -> DataFrame:
    """Dead letters as topic, key and value of a Kafka sink."""
    body = F.to_json(F.struct(*[c for c in letters.columns if c != "dlq_topic"]))
    return letters.select(F.col("dlq_topic").alias("topic"), F.col("original_key").alias("key"), body.alias("value"))


def dlq_stats(letters: DataFrame) -> DataFrame:
    return letters.groupBy("original_topic").agg(F.count("*").alias("messages"))


def dlq_reprocess(letters: DataFrame, topic: TopicConfig, as_of: dt.datetime, max_messages: int) -> DataFrame:
    """Send the oldest ``max_messages`` dead letters of a topic through parsing and rules again.

    The result has the checked columns; ``outcome`` is ``accepted`` or ``still_failing``.
    """
    oldest = (
        letters.filter(F.col("original_topic") == topic.topic)
        .orderBy("original_timestamp", "original_partition", "original_offset")
        .limit(max_messages)
    )
    checked = reprocessed(oldest, topic, as_of)
    return checked.withColumn("outcome", F.when(F.col("reject_rule").isNull(), F.lit("accepted")).otherwise(F.lit("still_failing")))


def reprocessed(letters: DataFrame, topic: TopicConfig, as_of: dt.datetime, keep: list[str] | None = None) -> DataFrame:
    """Dead letters of a topic as messages again, parsed and checked, with ``first_reason`` and the columns ``keep``."""
    again = letters.select(
        F.col("original_topic").alias("topic"),
        F.col("original_partition").alias("partition"),
        F.col("original_offset").alias("offset"),
        F.col("original_key").alias("key"),
        F.col("original_value").alias("value"),
        F.col("original_timestamp").alias("timestamp"),
        F.col("error_reason").alias("first_reason"),
        *(keep or []),
    )
    return validate(parse(again, topic, as_of), topic, as_of)


def unrouted(routed: DataFrame) -> DataFrame:
    """Messages of unknown topics in the shape of rejects."""
    return routed.filter(F.col("route_error").isNotNull()).withColumns(
        {"reject_rule": F.lit("route"), "reject_reason": F.col("route_error")}
    )


