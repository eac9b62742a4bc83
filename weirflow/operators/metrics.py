"""Counters, rates, health and activity reports over checked messages and timing tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.functions.ordered import CHUNK, ROWS_PER_CHUNK, range_chunks
from weirflow.functions.times import as_of_timestamp
from weirflow.session import reliable_checkpoint

# Health limits, slow-operation limits in ms, reported quantiles.
DOWN_RATE, DEGRADED_RATE = 0.1, 0.05
SLOW_PROCESSING_MS, SLOW_WRITE_MS = 100, 5_000
SLOW_LIMITS_MS = {"S3_WRITE": 5000, "RECORD_PROCESSING": 100, "SCHEMA_VALIDATION": 50, "TASK_PUT": 1000, "TASK_FLUSH": 10000}
DEFAULT_SLOW_LIMIT_MS = 1000
QUANTILES = (0.50, 0.90, 0.95, 0.99)
ALERT_FAILURES_PER_SECOND = 0.1
ALERT_FLUSH_SECONDS = 30


def counters() -> list[Column]:
    """Aggregates over checked messages (``reject_rule``) and their ``duration_ms``."""
    failed = F.col("reject_rule").isNotNull()
    return [
        F.count("*").alias("processed"),
        F.count_if(failed).alias("failed"),
        F.count_if(F.col("reject_rule") == "parse").alias("schema_failures"),
        F.count_if(failed).alias("dlq_messages"),
    ]


def rate(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def topic_metrics(checked: DataFrame) -> DataFrame:
    """Counters and failure rate per topic."""
    return checked.groupBy("topic").agg(*counters()).withColumn("failure_rate", rate(F.col("failed"), F.col("processed")))


PROCESS, WRITE, BREAKER_OPEN, OVERALL = "PROCESS", "WRITE", "BREAKER_OPEN", "overall"


def operation_metrics(log: DataFrame, key: str = "topic") -> DataFrame:
    """All counters per key, and one row ``overall``, from a log of operations.

    The log has ``key``, ``operation`` (PROCESS, WRITE or BREAKER_OPEN), ``failed`` and
    ``duration_ms``.  One grouping with map-side combine makes both levels.
    """
    op, failed = F.col("operation"), F.coalesce("failed", F.lit(False))
    mean = lambda kind: F.avg(F.when(op == kind, F.col("duration_ms")))
    totals = log.rollup(key).agg(
        F.grouping(key).alias("_all"),
        F.count_if(op == PROCESS).alias("processed"),
        F.count_if((op == PROCESS) & failed).alias("failed"),
        F.count_if(op == WRITE).alias("writes"),
        F.count_if((op == WRITE) & failed).alias("write_failures"),
        F.count_if(op == BREAKER_OPEN).alias("breaker_opens"),
        mean(PROCESS).alias("mean_processing_ms"),
        mean(WRITE).alias("mean_write_ms"),
    )
    return totals.withColumns(
        {
            key: F.when(F.col("_all") == 1, F.lit(OVERALL)).otherwise(F.col(key)),
            "failure_rate": rate(F.col("failed"), F.col("processed")),
            "write_failure_rate": rate(F.col("write_failures"), F.col("writes")),
        }
    ).drop("_all")


def observed(checked: DataFrame, name: str) -> DataFrame:
    """The same counters as an observation, for progress events of a running stream."""
    return checked.observe(name, *counters())


def _status(*rates: Column) -> Column:
    worst = F.greatest(*rates) if len(rates) > 1 else rates[0]
    return F.when(worst > DOWN_RATE, F.lit("DOWN")).when(worst > DEGRADED_RATE, F.lit("DEGRADED")).otherwise(F.lit("UP"))


def health(metrics: DataFrame) -> DataFrame:
    """Status columns from failure_rate, write_failure_rate, mean_processing_ms and mean_write_ms."""
    slow_processing = F.col("mean_processing_ms") > SLOW_PROCESSING_MS
    slow_write = F.col("mean_write_ms") > SLOW_WRITE_MS
    return metrics.withColumns(
        {
            "overall_status": _status(F.col("failure_rate"), F.col("write_failure_rate")),
            "processing_status": _status(F.col("failure_rate")),
            "storage_status": _status(F.col("write_failure_rate")),
            "performance_status": F.when(slow_processing | slow_write, F.lit("DEGRADED")).otherwise(F.lit("UP")),
            "slow_processing": slow_processing,
            "slow_writes": slow_write,
        }
    )


def failure_rate_windows(events: DataFrame, failed: Column, time: str = "timestamp", width: str = "5 minutes", seconds: int = 300) -> DataFrame:
    """Failures per second in tumbling windows, with the alert flag.  Works on streams as well: put a
    watermark on ``time`` first."""
    windows = events.groupBy(F.window(time, width).alias("_w"), "topic").agg(
        F.count("*").alias("messages"), F.count_if(failed).alias("failures")
    )
    per_second = F.col("failures") / F.lit(float(seconds))
    return windows.select(
        F.col("_w.start").alias("window_start"),
        "topic",
        "messages",
        "failures",
        per_second.alias("failures_per_second"),
        (per_second > ALERT_FAILURES_PER_SECOND).alias("alert"),
    )


def flush_latency_alerts(timings: DataFrame, time: str = "timestamp", width: str = "5 minutes") -> DataFrame:
    """Exact 95th percentile of ``duration_ms`` per window and table, with the alert flag."""
    placed = timings.select(F.window(time, width)["start"].alias("window_start"), "table_name", "duration_ms")
    keys = ["window_start", "table_name"]
    flushes = placed.groupBy(*keys).agg(F.count("*").alias("flushes"))
    p95 = exact_quantiles(placed, keys, "duration_ms", (0.95,)).select(*keys, F.col("value").alias("p95_ms"))
    return flushes.join(p95, keys, "left").select(*keys, "flushes", "p95_ms", (F.col("p95_ms") > ALERT_FLUSH_SECONDS * 1000).alias("alert"))


def flush_latency_sketch(timings: DataFrame, time: str = "timestamp", width: str = "5 minutes") -> DataFrame:
    """The same on a stream, where a window cannot be read twice: the percentile comes from a summary
    of bounded size, with a rank error of 1/10000 of the window's rows."""
    p95 = F.percentile_approx("duration_ms", 0.95, 10_000)
    return (
        timings.groupBy(F.window(time, width).alias("_w"), "table_name")
        .agg(F.count("*").alias("flushes"), p95.alias("p95_ms"))
        .select(F.col("_w.start").alias("window_start"), "table_name", "flushes", "p95_ms", (F.col("p95_ms") > ALERT_FLUSH_SECONDS * 1000).alias("alert"))
    )


def partition_activity(log: DataFrame, as_of: dt.datetime, hours: int = 1) -> DataFrame:
    """Messages, last activity and instances per topic and business date since ``hours`` ago."""
    since = as_of_timestamp(as_of - dt.timedelta(hours=hours))
    return (
        log.filter(F.col("processed_at") >= since)
        .groupBy("topic", "cob_date")
        .agg(
            F.count("*").alias("message_count"),
            F.max("processed_at").alias("last_activity"),
            F.countDistinct("instance_id").alias("instance_count"),
        )
    )


def hot_partitions(activity: DataFrame, threshold: int) -> DataFrame:
    """Partitions with more messages than ``threshold``, the busiest first."""
    return activity.filter(F.col("message_count") > threshold).orderBy(F.desc("message_count"), "topic", "cob_date")


def activity_summary(log: DataFrame, since: dt.datetime) -> DataFrame:
    return (
        log.filter(F.col("processed_at") >= as_of_timestamp(since)).groupBy("topic", "cob_date").agg(F.count("*").alias("message_count"))
    )


def instance_summary(log: DataFrame, since: dt.datetime) -> DataFrame:
    return (
        log.filter(F.col("processed_at") >= as_of_timestamp(since)).groupBy("instance_id").agg(F.count("*").alias("message_count"))
    )


def retained(log: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` days; write them back with overwrite mode to clean a log."""
    return log.filter(F.col("processed_at") >= as_of_timestamp(as_of - dt.timedelta(days=days)))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: tuple[float, ...] = QUANTILES, rows_per_bin: int = ROWS_PER_CHUNK) -> DataFrame:
    """Exact quantiles (smallest value that at least the share q does not exceed) per key.

    Equal values are one row after the map side.  The distinct values are range-partitioned by key and
    value into bins of about ``rows_per_bin``, wherever the values of a key lie close together; the
    bin that holds each wanted rank is found on the small table of bins, and only those bins are
    ranked, so neither a frequent key nor a narrow range of values grows a task.
    """
    values = df.select(*keys, F.col(value).alias("_x")).filter("_x is not null").groupBy(*keys, "_x").agg(F.count("*").alias("_n"))
    distinct = range_chunks(reliable_checkpoint(values), [*keys, "_x"], rows_per_chunk=rows_per_bin).withColumnRenamed(CHUNK, "_bin")
    bins = distinct.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    located = (
        bins.withColumns({"_end": F.sum("_n").over(upto), "_all": F.sum("_n").over(whole)})
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("quantile", F.explode(F.array(*[F.lit(q) for q in quantiles])))
        .withColumn("_rank", F.greatest(F.lit(1), F.ceil(F.col("quantile").cast("decimal(6,4)") * F.col("_all"))))
        .filter((F.col("_rank") > F.col("_start")) & (F.col("_rank") <= F.col("_end")))
        .select(*keys, "_bin", "quantile", "_rank", "_start", "_all")
    )
    inside = Window.partitionBy(*keys, "_bin").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    spots = located.select(*keys, "_bin").distinct()
    counted = distinct.join(spots, [*keys, "_bin"]).withColumn("_seen", F.sum("_n").over(inside))
    return (
        counted.join(located, [*keys, "_bin"])
        .filter(F.col("_start") + F.col("_seen") >= F.col("_rank"))
        .groupBy(*keys, "quantile")
        .agg(F.min("_x").alias("value"), F.first("_all").alias("samples"))
    )


def slow_limit_ms(operation: Column) -> Column:
    limit = F.lit(DEFAULT_SLOW_LIMIT_MS)
    for name, ms in SLOW_LIMITS_MS.items():
        limit = F.when(operation == name, F.lit(ms)).otherwise(limit)
    return limit


def slow_operations(timings: DataFrame) -> DataFrame:
    """Add ``limit_ms`` and ``is_slow`` to (operation, duration_ms) rows."""
    return timings.withColumn("limit_ms", slow_limit_ms(F.col("operation"))).withColumn("is_slow", F.col("duration_ms") > F.col("limit_ms"))
