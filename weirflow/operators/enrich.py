"""Enrichment: temporal, derived and quality columns, and the metadata columns of the tables.

All functions are projections over ``rec`` and the envelope columns; none reads a clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.config import TopicConfig
from weirflow.functions.once import compute_once
from weirflow.functions.times import DAY_MS, as_of_millis, as_of_timestamp, cob_date, event_time, iso_text
from weirflow.functions.values import BLANKS, is_json_object
from weirflow.operators.rules import _field, with_numbers, without_numbers

# Fixed values of the scoring and priority rules.
ALERT_TYPES = ("SECURITY_ALERT", "FRAUD_DETECTED")
MONEY_TYPES = ("PAYMENT", "REFUND")
VIEW_TYPES = ("PAGE_VIEW", "PRODUCT_VIEW")
CRITICAL_TYPES = ("PAYMENT", "LOGIN_FAILED", "SECURITY_ALERT")
HIGH_AMOUNT = 10_000
RAISED_AMOUNT = 1_000
CONSISTENT_DAYS = 30
RECORD_VERSION = "1.0.0"
PROCESSING_VERSION = "1.0"


def temporal_features() -> dict[str, Column]:
    """Hour, ISO weekday (Monday = 1), weekend flag and quarter of the event time in UTC."""
    at = event_time(F.col("rec.timestamp"))
    weekday = F.weekday(at) + 1
    return {
        "hour_of_day": F.hour(at),
        "day_of_week": weekday,
        "is_weekend": weekday >= 6,
        "quarter": F.quarter(at),
    }


def calculated_total() -> Column:
    """unit_price x quantity; needs the number columns of ``with_numbers``."""
    return F.col("_unit_price") * F.col("_quantity")


def event_priority(rec: T.StructType) -> Column:
    kind, amount = _field(rec, "event_type"), F.col("_amount")
    money = kind.isin(*MONEY_TYPES)
    return (
        F.when(kind.isin(*ALERT_TYPES), F.lit(1))
        .when(money & (amount > HIGH_AMOUNT) & ~F.isnan(amount), F.lit(1))
        .when(money & (amount > RAISED_AMOUNT) & ~F.isnan(amount), F.lit(2))
        .when(kind.startswith("USER_"), F.lit(3))
        .when(kind.isin(*VIEW_TYPES), F.lit(4))
        .otherwise(F.lit(3))
    )


def completeness(rec: T.StructType) -> Column:
    """Share of the declared fields that are present."""
    present = sum((F.col("rec")[name].isNotNull().cast("int") for name in rec.names), F.lit(0))
    return present / F.lit(float(len(rec.names)))


def consistency_score(rec: T.StructType, as_of: dt.datetime) -> Column:
    kind, stamp = _field(rec, "event_type"), _field(rec, "timestamp")
    minus = lambda condition, points: F.when(condition, F.lit(points)).otherwise(F.lit(0.0))
    millis = stamp.try_cast("bigint")
    return F.greatest(
        F.lit(0.0),
        F.lit(1.0)
        - minus((kind == "PURCHASE") & _field(rec, "amount").isNull(), 0.3)
        - minus((kind == "USER_ACTION") & _field(rec, "user_id").isNull(), 0.4)
        - minus(F.abs(as_of_millis(as_of) - millis) > CONSISTENT_DAYS * DAY_MS, 0.2)
        - minus(stamp.isNotNull() & millis.isNull(), 0.5),
    )


def is_high_value() -> Column:
    return F.coalesce((F.col("_amount") > HIGH_AMOUNT) & ~F.isnan("_amount"), F.lit(False))


def is_critical_event(rec: T.StructType) -> Column:
    return F.coalesce(_field(rec, "event_type").isin(*CRITICAL_TYPES), F.lit(False))


def processing_metadata() -> dict[str, Column]:
    """Metadata that is the same on every replay."""
    return {
        "processed_topic": F.col("topic"),
        "processed_cob": F.col("cob"),
        "processing_version": F.lit(PROCESSING_VERSION),
    }


def enrich(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Add every enrichment column to checked messages."""
    numbered = with_numbers(df)
    rec = numbered.schema["rec"].dataType
    out = {
        **(temporal_features() if "timestamp" in rec.names else {}),
        "calculated_total": calculated_total(),
        "event_priority": event_priority(rec),
        "completeness": completeness(rec),
        "consistency_score": consistency_score(rec, as_of),
        "is_high_value": is_high_value(),
        "is_critical_event": is_critical_event(rec),
        **processing_metadata(),
    }
    return without_numbers(numbered.withColumns(out))


ENRICHMENT_COLUMNS = [
    "hour_of_day", "day_of_week", "is_weekend", "quarter", "calculated_total", "event_priority",
    "completeness", "consistency_score", "is_high_value", "is_critical_event",
    "processed_topic", "processed_cob", "processing_version",
]


def kafka_metadata(as_of: dt.datetime) -> dict[str, Column]:
    """Where a row came from and when it was taken in."""
    return {
        "_kafka_topic": F.col("topic"),
        "_kafka_partition": F.col("partition"),
        "_kafka_offset": F.col("offset"),
        "_kafka_key": F.col("key"),
        "_processed_at": F.lit(iso_text(as_of)),
        "_ingestion_timestamp": F.lit(iso_text(as_of)),
    }


def record_metadata(as_of: dt.datetime) -> Column:
    """The nested metadata object of JSON Lines records."""
    return F.struct(
        F.lit(iso_text(as_of)).alias("processing_timestamp"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.unix_millis("timestamp").alias("kafka_timestamp"),
        F.lit(RECORD_VERSION).alias("processor_version"),
    )


def with_record_metadata(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Envelopes -> ``record``: JSON text of the value's members plus ``_metadata``.

    A value that is no JSON object goes under ``original_value``; without a value only the metadata
    remains.
    """
    meta = F.to_json(record_metadata(as_of))
    bare = F.col("value").startswith("{") & F.col("value").endswith("}")
    text = F.when(bare, F.col("value")).otherwise(F.trim("value", F.lit(BLANKS)))
    is_object = is_json_object(F.col("value"), F.try_parse_json("value"))
    # Between the braces, cut by bytes: characters would have to be counted.
    members = F.substring(text.cast("binary"), F.lit(2), F.octet_length(text) - 2).cast("string")
    # {"original_value":"..."}: the text ends in a quote, so only the closing brace is trimmed.
    original = F.to_json(F.struct(F.col("value").alias("original_value")))
    head = (
        F.when(F.col("value").isNull(), F.lit("{"))
        # One branch asks whether it is an object: each that does parses the value again.
        .when(is_object, F.when(text.rlike(r"^\{[ \t\r\n]*\}\z"), F.lit("{")).otherwise(F.concat(F.lit("{"), members, F.lit(","))))
        .otherwise(F.concat(F.rtrim(original, F.lit("}")), F.lit(",")))
    )
    # Computed apart from what reads it: inside a from_json Spark would interpret it row by row.
    return compute_once(df, {"record": F.concat(head, F.lit('"_metadata":'), meta, F.lit("}"))})


METADATA_TYPE = T.StructType(
    [
        T.StructField("processing_timestamp", T.StringType(), False),
        T.StructField("kafka_topic", T.StringType(), False),
        T.StructField("kafka_partition", T.IntegerType(), False),
        T.StructField("kafka_offset", T.LongType(), False),
        T.StructField("kafka_timestamp", T.LongType(), True),
        T.StructField("processor_version", T.StringType(), False),
    ]
)


def enhanced_schema(name: str, original: T.DataType | None) -> tuple[str, T.StructType] | None:
    """Name and type of a record after metadata has been added; None stays None."""
    if original is None:
        return None
    base = original if isinstance(original, T.StructType) else T.StructType([T.StructField("original_value", original)])
    return f"{name}_enhanced", T.StructType([*base.fields, T.StructField("_metadata", METADATA_TYPE)])


_CLOCK_PARTS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def partition_columns(df: DataFrame, columns: tuple[str, ...], at: Column, known: set[str] | None = None) -> DataFrame:
    """Add partition columns: parts of ``at``, existing columns unchanged, others "unknown".

    ``at`` is a timestamp Column, e.g. the literal ``as_of`` or the event time.
    """
    present = known if known is not None else set(df.columns)
    added = {}
    for name in columns:
        pattern = _CLOCK_PARTS.get(name.lower())
        if pattern:
            added[name.lower()] = F.date_format(at, pattern)
        elif name not in present:
            added[name] = F.lit("unknown")
    return df.withColumns(added) if added else df


def cob_partition_values() -> dict[str, Column]:
    day = cob_date(F.col("cob"))
    return {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
        "cob_date": F.col("cob"),
    }


def cob_path(topic: TopicConfig, root: str | None = None) -> Column:
    """Directory of a business date: ``<table>/year=/month=/day=/``."""
    base = F.lit(f"{root.rstrip('/')}/{topic.destination.path}" if root else f"s3://{topic.destination.bucket}/{topic.destination.path}")
    return F.concat(base, F.date_format(cob_date(F.col("cob")), "'/year='yyyy'/month='MM'/day='dd'/'"))


def message_transform(parsed: DataFrame, topic: TopicConfig, as_of: dt.datetime) -> DataFrame:
    """Record fields plus message metadata plus partition columns taken from ``as_of``."""
    flat = parsed.select("rec.*", *[c.alias(n) for n, c in kafka_metadata(as_of).items()])
    return partition_columns(flat, topic.destination.partition_columns, as_of_timestamp(as_of))


def table_rows(checked: DataFrame, topic: TopicConfig, as_of: dt.datetime) -> DataFrame:
    """Accepted messages -> the rows of the topic's table.

    Date partition columns follow the business date of the record, so that a replay files a row where
    the first delivery filed it.
    """
    enriched = enrich(checked, as_of)
    rec = enriched.schema["rec"].dataType
    extras = [F.col(c) for c in ENRICHMENT_COLUMNS if c in enriched.columns]
    flat = enriched.select(
        "rec.*",
        *[c.alias(n) for n, c in kafka_metadata(as_of).items()],
        *extras,
        as_of_millis(as_of).alias("processed_timestamp"),
        F.col("cob").alias("cob_date"),
    )
    day = cob_date(F.col("cob_date")).cast("timestamp")
    return partition_columns(flat, topic.destination.partition_columns, day, set(rec.names) | set(flat.columns))
