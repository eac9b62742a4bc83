"""Error logs: which errors are worth a retry, why, and when to try again.

Input rows have ``error_class``, ``error_message`` and ``cause_message``.  Four rule sets are in use
by different parts of a pipeline and do differ; each is a list of conditions and a default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the rule sets.
IO_CLASSES = ("ConnectException", "SocketTimeoutException", "UnknownHostException", "TimeoutException", "IOException", "FileNotFoundException")
SERVICE_CLASSES = "ServiceException|ThrottlingException|InternalServerError|ServiceUnavailableException"
TABLE_CLASSES = "ConcurrentModificationException|FileNotFoundException"
TRANSIENT_WORDS = "timeout|connection|unavailable|throttl|rate limit|too many requests"
HTTP_CODES = "502|503|504|429|408|500"
IO_WORDS = "connection|timeout|network|unavailable|refused|reset"
WRITER_CLASSES = SERVICE_CLASSES + "|SlowDown|" + TABLE_CLASSES + "|PartialWriteException"
WRITER_WORDS = TRANSIENT_WORDS + "|service temporarily|try again"
WRITE_YES = "timeout|connection|network|throttle|rate limit"
WRITE_NO = "schema|validation"
RULE_SETS = ("general", "table_writer", "write_error", "listener")

BASE_BACKOFF_MS = 1_000
MAX_BACKOFF_MS = 30_000
JITTER = 0.25


def is_retriable(rule_set: str) -> Column:
    kind = F.coalesce("error_class", F.lit(""))
    message = F.lower(F.coalesce("error_message", F.lit("")))
    cause = F.coalesce("cause_message", F.lit(""))
    if rule_set == "general":
        return kind.isin(*IO_CLASSES) | kind.rlike(SERVICE_CLASSES) | kind.rlike(TABLE_CLASSES) | message.rlike(TRANSIENT_WORDS) | cause.rlike(HTTP_CODES)
    if rule_set == "table_writer":
        return kind.rlike("Connect|Timeout") | (kind.contains("IO") & message.rlike(IO_WORDS)) | kind.rlike(WRITER_CLASSES) | message.rlike(WRITER_WORDS)
    if rule_set == "write_error":
        return message.rlike(WRITE_YES) | ~message.rlike(WRITE_NO)
    if rule_set == "listener":
        return kind.isin("IOException", "SocketTimeoutException", "ConnectException", "UnknownHostException", "FileNotFoundException") | message.contains("timeout")
    raise ValueError(f"unknown rule set {rule_set!r}")


def classification_reason(retriable: Column) -> Column:
    # The texts of the reasons, which consumers compare.
    kind = F.coalesce("error_class", F.lit(""))
    message = F.lower(F.coalesce("error_message", F.lit("")))
    why = (
        F.when(kind.rlike("Connect|Timeout|IO"), F.lit("Network/IO issue"))
        .when(kind.rlike("Service|Throttling"), F.lit("Service availability issue"))
        .when(message.rlike("timeout|connection"), F.lit("Message indicates transient issue"))
        .otherwise(F.lit("Heuristic classification"))
    )
    return (
        F.when(kind == "RetriableException", F.lit("Already marked as retriable"))
        .when(kind == "NonRetriableException", F.lit("Already marked as non-retriable"))
        .when(retriable, F.concat(F.lit("Classified as retriable: "), why))
        .otherwise(F.lit("Classified as non-retriable: permanent failure or unknown error type"))
    )


def classify(errors: DataFrame, rule_set: str = "general") -> DataFrame:
    """Add ``retriable`` and ``reason``.  Errors that already carry a mark keep it."""
    marked = (
        F.when(F.col("error_class") == "RetriableException", F.lit(True))
        .when(F.col("error_class") == "NonRetriableException", F.lit(False))
        .otherwise(is_retriable(rule_set))
    )
    return errors.withColumn("retriable", marked).withColumn("reason", classification_reason(F.col("retriable")))


def unit_draw(key: Column, attempt: Column) -> Column:
    """A number in [0, 1) that depends only on key and attempt, so schedules are repeatable."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), attempt.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def retry_delay_ms(key: Column, attempt: Column) -> Column:
    """Doubling back-off from one second with jitter (a quarter of the delay wide), at most 30 s.

    The exponent stops growing long after the limit is reached, so no number of attempts overflows.
    """
    plain = F.lit(BASE_BACKOFF_MS).cast("bigint") * F.pow(F.lit(2), F.least(attempt - 1, F.lit(40))).cast("bigint")
    jitter = (plain * F.lit(JITTER) * (unit_draw(key, attempt) - F.lit(0.5))).cast("bigint")
    return F.least(plain + jitter, F.lit(MAX_BACKOFF_MS).cast("bigint"))


def retry_schedule(failures: DataFrame, key: str, max_retries: Column | int) -> DataFrame:
    """One row per failure and attempt up to ``max_retries``."""
    limit = max_retries if isinstance(max_retries, Column) else F.lit(max_retries)
    attempts = F.when(limit >= 1, F.sequence(F.lit(1), limit.cast("int"))).otherwise(F.array().cast("array<int>"))
    return failures.withColumn("attempt", F.explode(attempts)).withColumn("delay_ms", retry_delay_ms(F.col(key), F.col("attempt")))
