"""Partition keys: the directory below which a record is filed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.functions.times import as_of_timestamp


def by_partition() -> Column:
    """``topic/partition=N``"""
    return F.concat(F.col("topic"), F.lit("/partition="), F.col("partition").cast("string"))


def by_time(as_of: dt.datetime, zone: str = "UTC") -> Column:
    """``topic/year=/month=/day=/hour=`` of the record's time; records without one get ``as_of``."""
    local = F.from_utc_timestamp(F.coalesce(F.col("timestamp"), as_of_timestamp(as_of)), zone)
    return F.concat(F.col("topic"), F.date_format(local, "'/year='yyyy'/month='MM'/day='dd'/hour='HH"))


STRATEGIES: dict[str, Callable[..., Column]] = {
    "DEFAULT": lambda as_of, zone: by_partition(),
    "TIME_BASED": by_time,
    "TOPIC_PARTITION": lambda as_of, zone: by_partition(),
}


def partition_key(strategy: str, as_of: dt.datetime, zone: str = "UTC") -> Column:
    """Choose a strategy by name in any case; unknown names mean DEFAULT."""
    return STRATEGIES.get((strategy or "").upper(), STRATEGIES["DEFAULT"])(as_of, zone)


def schema_subject(path: Column) -> Column:
    """Subject of a schema file: base name without extension and ``-schema``, plus ``-value``."""
    base = F.regexp_extract(path, r"([^/]*)\z", 1)
    stem = F.regexp_replace(base, r"(?s)^(.+)\.[^.]*\z", "$1")
    return F.concat(F.regexp_replace(stem, r"-schema\z", ""), F.lit("-value"))


def dlq_topic(topic: Column) -> Column:
    return F.concat(topic, F.lit("-dlq"))
