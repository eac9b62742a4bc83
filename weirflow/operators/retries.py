"""Retries of dead letters over rounds: attempts as state, due by the back-off, given up after a limit.

The ledger is a table below ``round=``: one row for each letter and attempt, with its outcome and the time at which the next
attempt is due.  A round reads the last row of each letter from the rounds before it, tries what is
due, and writes its rows in place of what it wrote before, so a round that runs again changes nothing.
Letters that were never tried are due at once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.config import TopicConfig
from weirflow.functions.times import as_of_timestamp
from weirflow.operators.dlq import reprocessed
from weirflow.operators.errors import retry_delay_ms
from weirflow.operators.sinks import write_partitions
from weirflow.session import stored

ROUND = "round"
ACCEPTED, FAILING, GIVEN_UP = "accepted", "still_failing", "given_up"
OUTCOMES = (ACCEPTED, FAILING, GIVEN_UP)
LETTER = ["original_topic", "original_partition", "original_offset"]
SORTED = LETTER[::-1]  # letters are sorted by what tells them apart first, not by a topic that most share
_LEDGER = f"original_topic string, original_partition int, original_offset bigint, attempt int, outcome string, due_ms bigint, {ROUND} int"


def ledger_rows(spark: SparkSession, ledger: str, before_round: int | None = None) -> DataFrame:
    """The ledger up to a round; none yet is an empty one."""
    try:
        rows = spark.read.schema(_LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], _LEDGER)
    return rows if before_round is None else rows.filter(F.col(ROUND) < before_round)


def last_attempts(rows: DataFrame) -> DataFrame:
    """The last row of each letter."""
    # Numbers only: of a text or a struct the rows would have to be sorted.
    number = F.array_position(F.array(*map(F.lit, OUTCOMES)), F.col("outcome"))
    last = rows.groupBy(*SORTED).agg(F.max("attempt").alias("attempt"), F.max_by(number, "attempt").alias("_n"), F.max_by("due_ms", "attempt").alias("due_ms"))
    return last.select(*LETTER, "attempt", F.element_at(F.array(*map(F.lit, OUTCOMES)), F.col("_n").cast("int")).alias("outcome"), "due_ms")


def due_letters(letters: DataFrame, rows: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Letters that are to be tried at ``as_of``, with ``attempt``, the number of this attempt."""
    last = last_attempts(rows)
    now = F.unix_millis(as_of_timestamp(as_of))
    state = letters.join(last, SORTED, "left")
    due = F.col("attempt").isNull() | ((F.col("outcome") == FAILING) & (F.col("due_ms") <= now))
    return state.filter(due).select(*letters.columns, (F.coalesce("attempt", F.lit(0)) + 1).alias("attempt"))


def retry_round(letters: DataFrame, ledger: str, round_no: int, topic: TopicConfig, as_of: dt.datetime, max_retries: int | None = None) -> DataFrame:
    """Try the due letters of a topic under the topic's present rules and write the round to the ledger.

    Returns what was tried, in the columns of :func:`weirflow.operators.dlq.reprocessed`, with ``attempt``,
    ``outcome`` (accepted, still_failing, given_up) and ``due_ms``.  Accepted letters go to the table,
    given-up ones stay dead; both are never tried again.  A letter that is there twice counts once.
    """
    limit = max_retries if max_retries is not None else topic.processing.max_retries
    spark = letters.sparkSession
    mine = letters.filter(F.col("original_topic") == topic.topic).dropDuplicates(SORTED)
    due = due_letters(mine, ledger_rows(spark, ledger, round_no), as_of)
    tried = reprocessed(due, topic, as_of, ["attempt"])
    failed = F.when(F.col("attempt") >= limit, GIVEN_UP).otherwise(FAILING)
    key = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    wait = F.unix_millis(as_of_timestamp(as_of)) + retry_delay_ms(key, F.col("attempt"))
    judged = tried.withColumn("outcome", F.when(F.col("reject_rule").isNull(), ACCEPTED).otherwise(failed))
    judged = stored(judged.withColumn("due_ms", F.when(F.col("outcome") == FAILING, wait)), "retry-round")
    names = {"topic": "original_topic", "partition": "original_partition", "offset": "original_offset"}
    rows = judged.select(*[F.col(a).alias(b) for a, b in names.items()], "attempt", "outcome", "due_ms", F.lit(round_no).alias(ROUND))
    write_partitions(rows, ledger, (ROUND,), gather=False)  # all are of one round: gathered they would be one task's
    return judged


def open_letters(letters: DataFrame, ledger: str) -> DataFrame:
    """Letters that are neither accepted nor given up, once each, with the attempts made so far."""
    last = last_attempts(ledger_rows(letters.sparkSession, ledger))
    state = letters.dropDuplicates(LETTER).join(last, LETTER, "left")
    waiting = F.col("outcome").isNull() | (F.col("outcome") == FAILING)
    return state.filter(waiting).withColumn("attempt", F.coalesce("attempt", F.lit(0))).drop("outcome")
