"""The whole flow for one set of messages: route, parse, check, enrich, write both outputs."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.config import DEFAULT_TOPICS, DESTINATION, TopicConfig
from weirflow.functions.sides import small_side
from weirflow.operators.dedup import deduplicated
from weirflow.operators.dlq import dlq_envelope, unrouted
from weirflow.operators.enrich import table_rows
from weirflow.operators.jsonschema import check_schema, load_schema
from weirflow.operators.parse import JSON, parse
from weirflow.operators.route import route
from weirflow.operators.rules import Rule, accepted, rejected, validate
from weirflow.operators.sinks import BATCH, write_batch, write_partitions

DLQ_PATH = "dead-letters"
KINDS_AT_ONCE = 4  # kinds of topics that are written at the same time


def checked_messages(messages: DataFrame, topic: TopicConfig, as_of: dt.datetime) -> DataFrame:
    """Messages of one topic, parsed and checked; every message is kept.

    A topic with a schema file has its JSON messages checked against it, after the business rules.
    """
    parsed, schema = parse(messages, topic, as_of), load_schema(topic.schema_file)
    if schema is None:
        return validate(parsed, topic, as_of)
    checked = check_schema(parsed, schema)
    failed = (F.col("format") == JSON) & ~F.col("schema_valid")
    rule = Rule("json_schema", failed, F.concat(F.lit("JSON schema: "), F.array_join("schema_errors", ", ")))
    return validate(checked, topic, as_of, [rule]).drop("schema_errors", "schema_valid")


def accepted_rows(messages: DataFrame, topic: TopicConfig, as_of: dt.datetime) -> DataFrame:
    return table_rows(accepted(checked_messages(messages, topic, as_of)), topic, as_of)


def dead_letters(messages: DataFrame, topic: TopicConfig, as_of: dt.datetime) -> DataFrame:
    return dlq_envelope(rejected(checked_messages(messages, topic, as_of)), as_of)


def _kept_parts(checked: DataFrame) -> DataFrame:
    """What the two writes need: the record of accepted messages, the raw value of rejected ones."""
    refused = F.col("reject_rule").isNotNull()
    return checked.drop("headers", "format", "parse_error").withColumns(
        {"value": F.when(refused, F.col("value")), "rec": F.when(~refused, F.col("rec"))}
    )


def batch_clock(messages: DataFrame, started: Column | None = None) -> dt.datetime:
    """The "now" of a batch: its newest message time, but no later than the batch started.

    A stream gives the start that its checkpoint keeps for the batch, so a replay finds the same time;
    by default it is the present.  Without message times, or without messages, the start is the clock.
    """
    start = F.max(started) if started is not None else F.current_timestamp()
    bounded = F.unix_millis(F.least(F.max("timestamp").cast("timestamp"), start))
    row = messages.agg(bounded.alias("ms"), F.unix_millis(F.coalesce(start, F.current_timestamp())).alias("start")).first()
    return dt.datetime.fromtimestamp((row["ms"] if row["ms"] is not None else row["start"]) / 1000, dt.timezone.utc).replace(tzinfo=None)


def destination_groups(topics: tuple[TopicConfig, ...]) -> list[list[TopicConfig]]:
    """Topics whose messages are parsed, checked and filed in the same way."""
    groups: dict[tuple, list[TopicConfig]] = {}
    for topic in topics:
        place = topic.destination
        alike = (topic.schema.json(), topic.schema_file, topic.rules, topic.lenient, topic.processing.dedup, place.partition_columns, place.file_format)
        groups.setdefault(alike, []).append(topic)
    return list(groups.values())


def _with_destination(rows: DataFrame, topics: list[TopicConfig]) -> DataFrame:
    """Table rows of ``topics`` with the name of their table."""
    if len(topics) == 1:
        return rows.withColumn(DESTINATION, F.lit(topics[0].destination.table_name))
    names = rows.sparkSession.createDataFrame([(t.topic, t.destination.table_name) for t in topics], f"_kafka_topic string, {DESTINATION} string")
    return rows.join(small_side(names, len(topics)), "_kafka_topic")


def _write_group(messages: DataFrame, root: str, batch_id: int, topics: list[TopicConfig], now: dt.datetime, kept: list[DataFrame]) -> DataFrame:
    """Write the accepted rows of a group of topics and return its dead letters; what is to be freed after
    them is added to ``kept``."""
    one = topics[0]
    mine = deduplicated(messages.filter(F.col("topic").isin([t.topic for t in topics])), one.processing.dedup)
    checked = _kept_parts(checked_messages(mine, one, now)).persist(StorageLevel.MEMORY_AND_DISK)
    kept.append(checked)
    rows = _with_destination(table_rows(accepted(checked), one, now), topics).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    write_partitions(rows, root, (DESTINATION, BATCH, *one.destination.partition_columns), one.destination.file_format)
    return dlq_envelope(rejected(checked), now)


def write_messages(
    messages: DataFrame,
    root: str,
    batch_id: int,
    topics: tuple[TopicConfig, ...] = DEFAULT_TOPICS,
    as_of: dt.datetime | None = None,
    counted: bool = False,
) -> list[tuple[str, int, int]]:
    """Write a batch of mixed topics: one table per topic and one dead-letter table.

    Topics with one schema and one set of rules are parsed together and written by one job, in which
    the destination is the leading partition, so the number of jobs follows the kinds of topics and not
    the topics.  The kinds run beside each other.  Each message is parsed and checked once; the
    checked rows are kept (on disk if need be) for the dead letters.  Both writes are keyed by ``batch_id``,
    so after a crash anywhere the batch can run again.  If ``counted``, returns (topic, processed, failed)
    of each topic met, from the rows that are kept.
    """
    now = as_of or batch_clock(messages)
    groups = destination_groups(topics)
    letters = [dlq_envelope(unrouted(route(messages, topics)), now)]
    kept: list[DataFrame] = []
    try:
        with ThreadPoolExecutor(max(1, min(len(groups), KINDS_AT_ONCE))) as pool:
            work = inheritable_thread_target(messages.sparkSession)(lambda group: _write_group(messages, root, batch_id, group, now, kept))
            done = [pool.submit(work, group) for group in groups]
        letters += [future.result() for future in done]
        write_batch(reduce(DataFrame.unionByName, letters), f"{root.rstrip('/')}/{DLQ_PATH}", ("dlq_topic",), batch_id)
        if not counted:
            return []
        parts = [df.select("topic", F.col("reject_rule").isNotNull().alias("bad")) for df in kept]
        lost = unrouted(route(messages.select("topic"), topics)).select("topic", F.lit(True).alias("bad"))
        sums = reduce(DataFrame.unionByName, parts, lost).groupBy("topic").agg(F.count("*").alias("n"), F.count_if("bad").alias("failed"))
        return [(r["topic"], r["n"], r["failed"]) for r in sums.collect()]  # one row a topic
    finally:
        for df in kept:
            df.unpersist()
