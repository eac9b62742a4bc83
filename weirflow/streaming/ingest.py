"""Streaming ingestion.  The trigger replaces flush sizes and intervals; the checkpoint keeps offsets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow.config import DEFAULT_TOPICS, TopicConfig
from weirflow.functions.times import as_of_timestamp
from weirflow.operators.dedup import deduplicated_stream
from weirflow.operators.enrich import with_record_metadata
from weirflow.operators.metrics import failure_rate_windows
from weirflow.plans.flow import batch_clock, write_messages
from weirflow.plans.ledger import after_flush, record_run, run_results  # noqa: F401

STARTED = "_batch_started"

# Flush settings as triggers: every 60 seconds, or once over everything that is there.
EVERY_MINUTE = {"processingTime": "60 seconds"}
ALL_AVAILABLE = {"availableNow": True}


def ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    topics: tuple[TopicConfig, ...] = DEFAULT_TOPICS,
    as_of: dt.datetime | None = None,
    trigger: dict = EVERY_MINUTE,
    dedup: str | None = None,
    maintenance: bool = True,
) -> StreamingQuery:
    """Write a stream of envelopes to its tables and the dead-letter table, each batch exactly once.

    Without ``as_of`` every batch takes the newest message time in it, bounded by the start of the
    batch that the checkpoint keeps.  ``dedup`` ("offset" or "content") drops second deliveries across
    batches, within a day.  Each batch leaves one row a topic in the table of runs, or one row with the
    error if it fails, and its files in the ledger of files; with ``maintenance`` what is due for the
    tables that it wrote is done before the next batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, began = batch.sparkSession, dt.datetime.now(dt.timezone.utc)
        try:
            now = as_of or batch_clock(batch, F.col(STARTED))
            counts = write_messages(batch.drop(STARTED), root, batch_id, topics, now, counted=True)
            if maintenance:
                after_flush(spark, root, batch_id, topics, now)
        except Exception as error:
            record_run(spark, root, batch_id, [], began, dt.datetime.now(dt.timezone.utc), f"{type(error).__name__}: {error}"[:2000])
            raise
        record_run(spark, root, batch_id, counts, began, dt.datetime.now(dt.timezone.utc))

    # In a streaming plan this is the time at which the batch was planned, kept in the checkpoint.
    timed = deduplicated_stream(messages, dedup).withColumn(STARTED, F.current_timestamp())
    return timed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


_TIME_PARTS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def jsonl_layout(messages: DataFrame, strategy: str, as_of: dt.datetime) -> tuple[DataFrame, list[str]]:
    """Records as JSON text with the directory columns of a partition-key strategy."""
    records = with_record_metadata(messages, as_of)
    if strategy.upper() == "TIME_BASED":
        at = F.coalesce(F.col("timestamp"), as_of_timestamp(as_of))
        parts = {name: F.date_format(at, pattern) for name, pattern in _TIME_PARTS.items()}
        return records.select("topic", *[c.alias(n) for n, c in parts.items()], F.col("record").alias("value")), ["topic", *parts]
    return records.select("topic", "partition", F.col("record").alias("value")), ["topic", "partition"]


def ingest_jsonl(
    messages: DataFrame, path: str, checkpoint: str, as_of: dt.datetime, strategy: str = "DEFAULT", trigger: dict = EVERY_MINUTE
) -> StreamingQuery:
    """The second entry: records with nested metadata as JSON Lines, through the exactly-once file sink."""
    lines, columns = jsonl_layout(messages, strategy, as_of)
    return (
        lines.writeStream.format("text")
        .partitionBy(*columns)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def failure_rates(outcomes: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Failures per second in 5-minute windows of a stream of checked messages."""
    return failure_rate_windows(outcomes.withWatermark("timestamp", watermark), F.col("reject_rule").isNotNull())

