"""Error rules, retries, metrics, health, activity, breakers and dead letters."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.config import COMMERCE_EVENTS, USER_EVENTS
from weirflow.functions.breaker import TOPIC_BREAKER, BreakerSettings
from weirflow.operators import breaker, dlq, errors, metrics
from weirflow.plans.flow import checked_messages, dead_letters
from weirflow.plans.queries.messages_sql import CC, UC, sql
from weirflow.plans.queries.registry import AS_OF, AS_OF_2001, query
from weirflow.sources import envelopes as src

# ---- errors and retries ---------------------------------------------------------------------

# The derived error log: classes, messages and causes in the order in which an event picks them.
ERROR_CLASSES = (
    "ConnectException", "IOException", "ThrottlingException", "IllegalStateException", "ConcurrentModificationException",
    "RetriableException", "NonRetriableException", "SchemaValidationException", "SlowDownException", "SocketTimeoutException", "IOSecurityException",
)
ERROR_MESSAGES = (
    "Connection refused by host", "disk full", "Read TIMEOUT after 30s", None, "schema mismatch in field amount", "Rate limit exceeded", "please try again later", "network unreachable",
)
CAUSES = (None, "HTTP 503", "HTTP 404", "status=429 slow down", "bad request")


def _pick(items, index):
    return F.element_at(F.array(*[F.lit(i).cast("string") for i in items]), (index % len(items) + 1).cast("int"))


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One error per event."""
    n = F.col("event_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", _pick(ERROR_CLASSES, n).alias("error_class"), _pick(ERROR_MESSAGES, F.floor(n / 3)).alias("error_message"), _pick(CAUSES, F.floor(n / 7)).alias("cause_message")
    )


def _list(items) -> str:
    return "[" + ", ".join("NULL" if i is None else f"'{i}'" for i in items) + "]"


_ERRORS_SQL = f"""
el0 AS (SELECT event_id, ({_list(ERROR_CLASSES)})[CAST(event_id % 11 AS INTEGER) + 1] AS c, ({_list(ERROR_MESSAGES)})[CAST(event_id // 3 % 8 AS INTEGER) + 1] AS m, ({_list(CAUSES)})[CAST(event_id // 7 % 5 AS INTEGER) + 1] AS cause FROM events),
el AS (SELECT *, lower(coalesce(m, '')) AS lm FROM el0),
er AS (SELECT *,
  c IN ('ConnectException', 'SocketTimeoutException', 'UnknownHostException', 'TimeoutException', 'IOException', 'FileNotFoundException') OR regexp_matches(c, 'ServiceException|ThrottlingException|InternalServerError|ServiceUnavailableException|ConcurrentModificationException|FileNotFoundException')
    OR regexp_matches(lm, 'timeout|connection|unavailable|throttl|rate limit|too many requests') OR regexp_matches(coalesce(cause, ''), '502|503|504|429|408|500') AS general,
  regexp_matches(c, 'Connect|Timeout|ServiceException|ThrottlingException|InternalServerError|ServiceUnavailableException|SlowDown|ConcurrentModificationException|FileNotFoundException|PartialWriteException')
    OR (c LIKE '%IO%' AND regexp_matches(lm, 'connection|timeout|network|unavailable|refused|reset')) OR regexp_matches(lm, 'timeout|connection|unavailable|throttl|rate limit|too many requests|service temporarily|try again') AS table_writer,
  regexp_matches(lm, 'timeout|connection|network|throttle|rate limit') OR NOT regexp_matches(lm, 'schema|validation') AS write_error,
  c IN ('IOException', 'SocketTimeoutException', 'ConnectException', 'UnknownHostException', 'FileNotFoundException') OR lm LIKE '%timeout%' AS listener FROM el)
"""


def _mark(rule_set: str) -> str:
    return f"CASE c WHEN 'RetriableException' THEN true WHEN 'NonRetriableException' THEN false ELSE {rule_set} END"


_CLASSIFY_SQL = " UNION ALL ".join(
    f"""SELECT event_id, '{s}' AS rule_set, c AS error_class, {_mark(s)} AS retriable, CASE WHEN c = 'RetriableException' THEN 'Already marked as retriable' WHEN c = 'NonRetriableException' THEN 'Already marked as non-retriable'
    WHEN {s} THEN 'Classified as retriable: ' || CASE WHEN regexp_matches(c, 'Connect|Timeout|IO') THEN 'Network/IO issue' WHEN regexp_matches(c, 'Service|Throttling') THEN 'Service availability issue'
      WHEN regexp_matches(lm, 'timeout|connection') THEN 'Message indicates transient issue' ELSE 'Heuristic classification' END
    ELSE 'Classified as non-retriable: permanent failure or unknown error type' END AS reason FROM er"""
    for s in errors.RULE_SETS
)


@query("error_classify", sql(_ERRORS_SQL, select=_CLASSIFY_SQL))
def error_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error under each of the four rule sets."""
    log = error_log(spark, sf_dir)
    parts = [errors.classify(log, s).select("event_id", F.lit(s).alias("rule_set"), "error_class", "retriable", "reason") for s in errors.RULE_SETS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "retry_schedule",
    """
    WITH r AS (SELECT event_id, unnest(range(1, 1 + CASE WHEN event_type = 'purchase' THEN 7 ELSE 3 END)) AS attempt FROM events WHERE event_type IN ('error', 'purchase')),
    d AS (SELECT *, 1000 * CAST(power(2, attempt - 1) AS BIGINT) AS plain, CAST('0x' || left(md5(event_id || ':' || attempt), 8) AS BIGINT) / 4294967296.0::DOUBLE AS draw FROM r)
    SELECT event_id, CAST(attempt AS INTEGER) AS attempt, least(plain + CAST(trunc(plain * 0.25::DOUBLE * (draw - 0.5::DOUBLE)) AS BIGINT), 30000) AS delay_ms FROM d""",
)
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting times of every failed event up to the retry limit of its kind."""
    failures = spark.read.parquet(f"{sf_dir}/events.parquet").filter(F.col("event_type").isin("error", "purchase"))
    limit = F.when(F.col("event_type") == "purchase", F.lit(7)).otherwise(F.lit(3))
    return errors.retry_schedule(failures.select("event_id", "event_type"), "event_id", limit).select("event_id", "attempt", "delay_ms")


# ---- metrics and health ---------------------------------------------------------------------

_TOPIC_METRICS = """
, v AS (SELECT topic, reject_rule FROM uc UNION ALL SELECT topic, reject_rule FROM cc),
m AS (SELECT topic, count(*) AS processed, count(reject_rule) AS failed, count(*) FILTER (reject_rule = 'parse') AS schema_failures, count(reject_rule) AS dlq_messages FROM v GROUP BY topic)
"""


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = checked_messages(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF).select("topic", "reject_rule")
    commerce = checked_messages(src.commerce_envelopes(spark, sf_dir), COMMERCE_EVENTS, AS_OF_2001).select("topic", "reject_rule")
    return users.unionByName(commerce)


@query("topic_metrics", sql(UC, CC, select=_TOPIC_METRICS + "SELECT topic, processed, failed, schema_failures, dlq_messages, round(failed / processed, 6) AS failure_rate FROM m"))
def topic_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.topic_metrics(_checked(spark, sf_dir)).withColumn("failure_rate", F.round("failure_rate", 6))


def operation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is one message processed, each purchase one write, some errors open a breaker."""
    kind, value = F.col("event_type"), F.col("value")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("service", F.concat(F.lit("user-"), (F.col("user_id") % 50).cast("string")))
    processed = events.select("service", F.lit(metrics.PROCESS).alias("operation"), ((kind == "error") & (value < 30)).alias("failed"), value.alias("duration_ms"))
    written = events.filter(kind == "purchase").select("service", F.lit(metrics.WRITE), value < 10, value * 60)
    opened = events.filter((kind == "error") & (value < 5)).select("service", F.lit(metrics.BREAKER_OPEN), F.lit(False), F.lit(0.0))
    return processed.union(written).union(opened)


@query(
    "operation_metrics",
    """
    WITH e AS (SELECT 'user-' || (user_id % 50) AS service, event_type AS k, value AS v FROM events)
    SELECT coalesce(service, 'overall') AS service, count(*) AS processed, count(*) FILTER (k = 'error' AND v < 30) AS failed, count(*) FILTER (k = 'purchase') AS writes, count(*) FILTER (k = 'purchase' AND v < 10) AS write_failures,
      count(*) FILTER (k = 'error' AND v < 5) AS breaker_opens, round(avg(v), 4) AS mean_processing_ms, round(avg(v * 60) FILTER (k = 'purchase'), 4) AS mean_write_ms,
      round(count(*) FILTER (k = 'error' AND v < 30) / count(*), 6) AS failure_rate, round(CASE WHEN count(*) FILTER (k = 'purchase') = 0 THEN 0 ELSE count(*) FILTER (k = 'purchase' AND v < 10) / count(*) FILTER (k = 'purchase') END, 6) AS write_failure_rate
    FROM e GROUP BY ROLLUP (service)""",
)
def operation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = metrics.operation_metrics(operation_log(spark, sf_dir), "service")
    rounded = {c: F.round(c, d) for c, d in (("mean_processing_ms", 4), ("mean_write_ms", 4), ("failure_rate", 6), ("write_failure_rate", 6))}
    return measured.withColumns(rounded)


@query(
    "health_status",
    """
    WITH m AS (SELECT 'user-' || (user_id % 50) AS service, count(*) AS processed, count(*) FILTER (event_type = 'error' AND value < 30) AS failed, count(*) FILTER (event_type = 'purchase') AS writes,
        count(*) FILTER (event_type = 'purchase' AND value < 10) AS write_failures, avg(value) AS mp, avg(value * 60) FILTER (event_type = 'purchase') AS mw FROM events GROUP BY ALL),
    r AS (SELECT *, failed / processed AS fr, CASE WHEN writes = 0 THEN 0 ELSE write_failures / writes END AS wr FROM m)
    SELECT service, round(fr, 6) AS failure_rate, round(wr, 6) AS write_failure_rate, CASE WHEN greatest(fr, wr) > 0.1 THEN 'DOWN' WHEN greatest(fr, wr) > 0.05 THEN 'DEGRADED' ELSE 'UP' END AS overall_status,
      CASE WHEN fr > 0.1 THEN 'DOWN' WHEN fr > 0.05 THEN 'DEGRADED' ELSE 'UP' END AS processing_status, CASE WHEN wr > 0.1 THEN 'DOWN' WHEN wr > 0.05 THEN 'DEGRADED' ELSE 'UP' END AS storage_status,
      CASE WHEN mp > 100 OR mw > 5000 THEN 'DEGRADED' ELSE 'UP' END AS performance_status FROM r""",
)
def health_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health of fifty services from event outcomes and durations."""
    measured = metrics.operation_metrics(operation_log(spark, sf_dir), "service").filter(F.col("service") != metrics.OVERALL)
    return metrics.health(measured).select(
        "service", F.round("failure_rate", 6).alias("failure_rate"), F.round("write_failure_rate", 6).alias("write_failure_rate"),
        "overall_status", "processing_status", "storage_status", "performance_status",
    )


@query(
    "failure_rate_5m",
    sql(UC, select="""
    SELECT epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)) // 1000 AS window_start_ms, topic, count(*) AS messages, count(reject_rule) AS failures, round(count(reject_rule) / 300.0, 8) AS failures_per_second,
      count(reject_rule) / 300.0 > 0.1 AS alert FROM uc GROUP BY ALL"""),
)
def failure_rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checked_messages(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF)
    windows = metrics.failure_rate_windows(checked, F.col("reject_rule").isNotNull())
    return windows.select(
        F.unix_millis("window_start").alias("window_start_ms"), "topic", "messages", "failures", F.round("failures_per_second", 8).alias("failures_per_second"), "alert"
    )


@query(
    "flush_latency_alerts",
    """
    WITH t AS (SELECT ts, event_type AS table_name, CAST(floor(value * 150) AS BIGINT) AS duration_ms FROM events),
    p AS (SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) // 1000 AS window_start_ms, table_name, count(*) AS flushes, quantile_disc(duration_ms, 0.95) AS p95_ms FROM t GROUP BY ALL)
    SELECT *, p95_ms > 30000 AS alert FROM p""",
)
def flush_latency_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    timings = events.select(F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("table_name"), F.floor(F.col("value") * 150).alias("duration_ms"))
    alerts = metrics.flush_latency_alerts(timings, width="1 day")
    return alerts.select(F.unix_millis("window_start").alias("window_start_ms"), "table_name", "flushes", "p95_ms", "alert")


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processing log: topic, business date, time and instance of every event."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("events."), "event_type").alias("topic"),
        F.date_format("ts", "yyyy-MM-dd").alias("cob_date"),
        F.col("ts").cast("timestamp").alias("processed_at"),
        F.concat(F.lit("instance-"), (F.col("user_id") % 7).cast("string")).alias("instance_id"),
    )


LOG_END = dt.datetime(2024, 1, 30, 12)
_LOG_SQL = "log AS (SELECT 'events.' || event_type AS topic, strftime(ts, '%Y-%m-%d') AS cob_date, ts, 'instance-' || (user_id % 7) AS instance_id FROM events)"


@query(
    "partition_activity",
    sql(_LOG_SQL, select="""SELECT topic, cob_date, count(*) AS message_count, max(epoch_us(ts) // 1000) AS last_activity_ms, count(DISTINCT instance_id) AS instance_count
    FROM log WHERE ts >= TIMESTAMP '2024-01-29 12:00:00' GROUP BY topic, cob_date"""),
)
def partition_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = metrics.partition_activity(activity_log(spark, sf_dir), LOG_END, hours=24)
    return activity.withColumn("last_activity_ms", F.unix_millis("last_activity")).drop("last_activity")


@query(
    "hot_partitions",
    sql(_LOG_SQL, select="""SELECT topic, cob_date, count(*) AS message_count, max(epoch_us(ts) // 1000) AS last_activity_ms FROM log WHERE ts >= TIMESTAMP '2024-01-10 12:00:00'
    GROUP BY topic, cob_date HAVING count(*) > 65 ORDER BY message_count DESC, topic, cob_date"""),
)
def hot_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = metrics.partition_activity(activity_log(spark, sf_dir), LOG_END, hours=24 * 20)
    return metrics.hot_partitions(activity, 65).select("topic", "cob_date", "message_count", F.unix_millis("last_activity").alias("last_activity_ms"))


@query("activity_summary", sql(_LOG_SQL, select="SELECT topic, cob_date, count(*) AS message_count FROM log WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' GROUP BY topic, cob_date"))
def activity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.activity_summary(activity_log(spark, sf_dir), dt.datetime(2024, 1, 20))


@query("instance_summary", sql(_LOG_SQL, select="SELECT instance_id, count(*) AS message_count FROM log WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' GROUP BY instance_id"))
def instance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.instance_summary(activity_log(spark, sf_dir), dt.datetime(2024, 1, 20))


@query("retention_filter", sql(_LOG_SQL, select="SELECT topic, cob_date, epoch_us(ts) // 1000 AS processed_at_ms, instance_id FROM log WHERE ts >= TIMESTAMP '2024-01-23 12:00:00'"))
def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = metrics.retained(activity_log(spark, sf_dir), LOG_END, 7)
    return kept.select("topic", "cob_date", F.unix_millis("processed_at").alias("processed_at_ms"), "instance_id")


@query(
    "latency_percentiles",
    """
    WITH q AS (SELECT event_type AS operation, unnest([0.5, 0.9, 0.95, 0.99]) AS quantile, value FROM events),
    r AS (SELECT event_type AS operation, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT r.operation, CAST(p.quantile AS DOUBLE) AS quantile, min(r.value) AS value, any_value(r.n) AS samples FROM r, (SELECT unnest([0.5, 0.9, 0.95, 0.99]) AS quantile) p
    WHERE rn >= ceil(p.quantile * n) GROUP BY r.operation, p.quantile""",
)
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    timings = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("operation"), "value")
    return metrics.exact_quantiles(timings, ["operation"], "value")


_OPERATIONS = {"click": "RECORD_PROCESSING", "view": "SCHEMA_VALIDATION", "purchase": "S3_WRITE", "signup": "TASK_PUT", "error": "OTHER"}


@query(
    "slow_operations",
    """
    WITH t AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'RECORD_PROCESSING' WHEN 'view' THEN 'SCHEMA_VALIDATION' WHEN 'purchase' THEN 'S3_WRITE' WHEN 'signup' THEN 'TASK_PUT' ELSE 'OTHER' END AS operation,
        CAST(floor(value * CASE event_type WHEN 'purchase' THEN 60 WHEN 'click' THEN 1 WHEN 'view' THEN 1 ELSE 15 END) AS BIGINT) AS duration_ms FROM events),
    l AS (SELECT *, CASE operation WHEN 'S3_WRITE' THEN 5000 WHEN 'RECORD_PROCESSING' THEN 100 WHEN 'SCHEMA_VALIDATION' THEN 50 ELSE 1000 END AS limit_ms FROM t)
    SELECT event_id, operation, duration_ms, limit_ms, duration_ms > limit_ms AS is_slow FROM l WHERE duration_ms > limit_ms""",
)
def slow_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    operation = F.lit("OTHER")
    for name, op in _OPERATIONS.items():
        operation = F.when(kind == name, F.lit(op)).otherwise(operation)
    scale = F.when(kind == "purchase", F.lit(60)).when(kind.isin("click", "view"), F.lit(1)).otherwise(F.lit(15))
    timings = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", operation.alias("operation"), F.floor(F.col("value") * scale).alias("duration_ms"))
    return metrics.slow_operations(timings).filter("is_slow")


# ---- breakers -------------------------------------------------------------------------------


def call_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of ten services; one service has a third of them.  Errors and clicks are failures."""
    u = F.col("user_id")
    service = F.when(u % 3 == 0, F.lit("svc-main")).otherwise(F.concat(F.lit("svc-"), (u % 9).cast("string")))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        service.alias("service"),
        F.col("event_id").alias("call_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"),
        F.col("event_type").isin("error", "click").alias("failed"),
        (F.col("event_type") == "error").alias("trips"),
    )


_CALLS_SQL = """
calls AS (SELECT CASE WHEN user_id % 3 = 0 THEN 'svc-main' ELSE 'svc-' || (user_id % 9) END AS service, event_id AS call_id, epoch_us(ts) // 1000 AS at_ms, event_type IN ('error', 'click') AS failed, event_type = 'error' AS trips FROM events)
"""


@query(
    "failure_streaks",
    sql(_CALLS_SQL, select="""
    , g AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY service ORDER BY at_ms, call_id) AS island FROM calls)
    SELECT service, count(*) AS failures, min(at_ms) AS first_ms, max(at_ms) AS last_ms FROM g WHERE failed GROUP BY service, island HAVING count(*) >= 5"""),
)
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaker.failure_streaks(call_outcomes(spark, sf_dir))


def replay_sql(open_ms: int, trips: str, calls: str = _CALLS_SQL) -> str:
    """The breaker as a recursion over the calls of each service: k = 0 closed, 1 half-open, 2 open."""
    return f"""
WITH RECURSIVE {calls.strip()},
c AS (SELECT *, {trips} AS tr, row_number() OVER (PARTITION BY service ORDER BY at_ms, call_id) AS rn FROM calls),
run(service, rn, call_id, at_ms, failed, k, v, allowed) AS (
  SELECT service, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BOOLEAN), 0, CAST(0 AS BIGINT), true FROM (SELECT DISTINCT service FROM calls)
  UNION ALL
  SELECT service, rn, call_id, at_ms, failed,
    CASE WHEN blocked THEN 2 WHEN hk = 1 THEN CASE WHEN failed THEN 2 WHEN hv + 1 >= 3 THEN 0 ELSE 1 END ELSE CASE WHEN failed AND tr AND hv + 1 >= 5 THEN 2 ELSE 0 END END,
    CASE WHEN blocked THEN v WHEN hk = 1 THEN CASE WHEN failed THEN at_ms WHEN hv + 1 >= 3 THEN 0 ELSE hv + 1 END
         ELSE CASE WHEN NOT failed THEN 0 WHEN tr AND hv + 1 >= 5 THEN at_ms ELSE least(hv + 1, 5) END END,
    NOT blocked
  FROM (SELECT c.service, c.rn, c.call_id, c.at_ms, c.failed, c.tr, r.v, r.k = 2 AND c.at_ms - r.v <= {open_ms} AS blocked,
          CASE WHEN r.k = 2 THEN 1 ELSE r.k END AS hk, CASE WHEN r.k = 2 THEN 0 ELSE r.v END AS hv
        FROM run r JOIN c ON c.service = r.service AND c.rn = r.rn + 1))
SELECT service, call_id, at_ms, failed, allowed, CASE k WHEN 0 THEN 'CLOSED' WHEN 1 THEN 'HALF_OPEN' ELSE 'OPEN' END AS state FROM run WHERE rn > 0"""


@query("breaker_replay", replay_sql(60_000, "true"))
def breaker_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaker.breaker_replay(call_outcomes(spark, sf_dir).drop("trips"))


@query("breaker_replay_slow_reset", replay_sql(3_600_000, "true"))
def breaker_replay_slow_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An hour of waiting, so that open breakers do turn calls away."""
    return breaker.breaker_replay(call_outcomes(spark, sf_dir).drop("trips"), BreakerSettings(open_ms=3_600_000))


@query("topic_breaker_replay", replay_sql(30_000, "trips"))
def topic_breaker_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listener's breaker: only some failures open it, and it waits 30 seconds."""
    return breaker.breaker_replay(call_outcomes(spark, sf_dir), TOPIC_BREAKER)


# ---- dead letters ---------------------------------------------------------------------------

_LETTER_COLUMNS = """'user.events.v1-dlq' AS dlq_topic, topic AS original_topic, partition AS original_partition, "offset" AS original_offset, key AS original_key, value AS original_value,
  (epoch_us(ts) // 1000) AS original_timestamp_ms, reject_rule AS error_reason, CASE reject_rule WHEN 'parse' THEN 'ParseError' ELSE 'ValidationError' END AS error_class,
  CAST(1706745600000 AS BIGINT) AS dlq_timestamp_ms, '1.0' AS dlq_version"""


@query("dlq_envelope", sql(UC, select=f"SELECT {_LETTER_COLUMNS} FROM uc WHERE reject_rule IS NOT NULL"))
def dlq_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = dead_letters(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF)
    return letters.withColumns(
        {"original_timestamp_ms": F.unix_millis("original_timestamp"), "dlq_timestamp_ms": F.unix_millis("dlq_timestamp")}
    ).drop("original_timestamp", "dlq_timestamp", "error_message")


@query("dlq_stats", sql(UC, CC, select=_TOPIC_METRICS + "SELECT topic AS original_topic, failed AS messages FROM m"))
def dlq_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = dead_letters(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF)
    commerce = dead_letters(src.commerce_envelopes(spark, sf_dir), COMMERCE_EVENTS, AS_OF_2001)
    return dlq.dlq_stats(users.unionByName(commerce))


@query(
    "dlq_reprocess",
    sql(UC, select="""
    , o AS (SELECT * FROM uc WHERE reject_rule IS NOT NULL ORDER BY ts, partition, "offset" LIMIT 1000),
    again AS (SELECT *, CASE WHEN reject_rule IN ('product_required', 'event_type_format') AND regexp_full_match(user_id, '[a-zA-Z0-9-]{8,}') AND ms >= 1706745600000 - 157680000000 THEN 'accepted' ELSE 'still_failing' END AS outcome FROM o)
    SELECT reject_rule AS first_reason, outcome, count(*) AS messages FROM again GROUP BY ALL"""),
)
def dlq_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest thousand dead letters under relaxed rules: any case of event type, no product needed."""
    letters = dead_letters(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF)
    relaxed = replace(USER_EVENTS, rules=replace(USER_EVENTS.rules, event_type_pattern=r"^[A-Za-z_]+\z", product_types=("NONE",)))
    again = dlq.dlq_reprocess(letters, relaxed, AS_OF, 1000)
    return again.groupBy("first_reason", "outcome").agg(F.count("*").alias("messages"))
