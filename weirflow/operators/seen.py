"""An index of content fingerprints that outlives a job, so that a content is taken in once.

The index is a table below ``day=`` (the day of the job) and ``ingest_batch=``: topic and fingerprint of each content
that a job took in.  A job reads the days that still count, and of these only fingerprints: it drops second
deliveries inside its batch, tests what is left against a bitmap of the index, joins only the few rows
whose bit is set, and adds what is new.  Bodies of messages that are new do not move for it.

A batch that runs again does not see its own earlier entries and replaces them, so it gives the same rows.
Days that no longer count are never read; :func:`expired_days` names them for whoever deletes files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.bitmaps import key_bits, with_maybe
from weirflow.functions.times import as_of_date
from weirflow.operators.dedup import dedup_content
from weirflow.operators.sinks import BATCH, write_partitions
from weirflow.session import stored

DAY = "day"
KEEP_DAYS = 7
_ENTRY = f"topic string, fingerprint binary, {DAY} date, {BATCH} bigint"


def index_entries(spark: SparkSession, index: str, as_of: dt.datetime, keep_days: int = KEEP_DAYS) -> DataFrame:
    """(topic, fingerprint, day, ingest_batch) of the days that count at ``as_of``; only their directories are read."""
    try:
        entries = spark.read.schema(_ENTRY).parquet(index)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        entries = spark.createDataFrame([], _ENTRY)
    first = F.date_sub(as_of_date(as_of), keep_days)
    return entries.filter((F.col(DAY) >= first) & (F.col(DAY) <= as_of_date(as_of)))


def expired_days(spark: SparkSession, index: str, as_of: dt.datetime, keep_days: int = KEEP_DAYS) -> DataFrame:
    """The days of the index that no job reads any more."""
    old = spark.read.schema(_ENTRY).parquet(index).filter(F.col(DAY) < F.date_sub(as_of_date(as_of), keep_days))
    return old.select(DAY).distinct()


def unseen(messages: DataFrame, index: str, batch_id: int, as_of: dt.datetime, keep_days: int = KEEP_DAYS) -> DataFrame:
    """The first delivery of each content that no other job of the last ``keep_days`` days took in, with
    its ``fingerprint`` and the number of ``copies`` in this batch; nothing is added to the index.

    Contents are compared within a topic.  A null value is a content of its own, as is the empty one.
    """
    first = dedup_content(messages, ["topic"])
    marked = stored(first.withColumn("_fp", F.unhex(F.coalesce("fingerprint", F.lit("")))), "unseen")
    known = index_entries(messages.sparkSession, index, as_of, keep_days).filter(F.col(BATCH) != batch_id)
    known = stored(known.select("topic", F.col("fingerprint").alias("_fp")).distinct(), "seen")
    key = F.struct("topic", "_fp")
    tested = with_maybe(marked, key, stored(key_bits(known, key), "seen-bits"), "_maybe")
    doubtful = tested.filter("_maybe").join(known, ["topic", "_fp"], "left_anti")
    new = tested.filter("not _maybe").unionByName(doubtful)
    return new.drop("_fp", "_maybe")


def remember(new: DataFrame, index: str, batch_id: int, as_of: dt.datetime) -> None:
    """Add the contents of :func:`unseen` to the index, in place of what this batch added before."""
    entries = new.select("topic", F.unhex(F.coalesce("fingerprint", F.lit(""))).alias("fingerprint"), as_of_date(as_of).alias(DAY), F.lit(batch_id).cast("bigint").alias(BATCH))
    write_partitions(entries, index, (DAY, BATCH))


def take_in(messages: DataFrame, index: str, batch_id: int, as_of: dt.datetime, keep_days: int = KEEP_DAYS) -> DataFrame:
    """:func:`unseen`, then :func:`remember`: the rows that this job takes in."""
    new = stored(unseen(messages, index, batch_id, as_of, keep_days), "taken-in")
    remember(new, index, batch_id, as_of)
    return new
