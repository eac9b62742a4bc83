"""Enrichment and metadata columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.config import COMMERCE_EVENTS, ORDER_EVENTS, USER_EVENTS
from weirflow.operators import enrich as e
from weirflow.operators import rules as r
from weirflow.operators.parse import parse
from weirflow.plans.flow import checked_messages
from weirflow.plans.queries.messages_sql import ASOF_MS, CC, CP, OP, UE, UP, sql
from weirflow.plans.queries.registry import AS_OF, AS_OF_2001, query
from weirflow.sources import envelopes as src


def _commerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.with_numbers(parse(src.commerce_envelopes(spark, sf_dir), COMMERCE_EVENTS, AS_OF_2001))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.with_numbers(parse(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF))


def _rec(df: DataFrame):
    return df.schema["rec"].dataType


@query(
    "temporal_features",
    sql(UP, select="""
    , t AS (SELECT partition, "offset", make_timestamp(ms * 1000) AS tm FROM up WHERE parse_error IS NULL)
    SELECT partition, "offset", CAST(hour(tm) AS INTEGER) AS hour_of_day, CAST(isodow(tm) AS INTEGER) AS day_of_week, isodow(tm) >= 6 AS is_weekend, CAST(quarter(tm) AS INTEGER) AS quarter FROM t"""),
)
def temporal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _users(spark, sf_dir).filter("parse_error is null")
    return rows.select("partition", "offset", *[c.alias(n) for n, c in e.temporal_features().items()])


@query(
    "derived_total",
    sql(CP, select="SELECT event_type, count(*) AS messages, count(nprice * nquantity) AS with_total, round(sum(nprice * nquantity), 2) AS total FROM cp GROUP BY event_type"),
)
def derived_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _commerce(spark, sf_dir).select(F.col("rec.event_type").alias("event_type"), e.calculated_total().alias("calculated_total"))
    return rows.groupBy("event_type").agg(
        F.count("*").alias("messages"), F.count("calculated_total").alias("with_total"), F.round(F.sum("calculated_total"), 2).alias("total")
    )


_PRIORITY = """CASE WHEN event_type IN ('SECURITY_ALERT', 'FRAUD_DETECTED') THEN 1 WHEN event_type IN ('PAYMENT', 'REFUND') AND namount > 10000 AND NOT isnan(namount) THEN 1
  WHEN event_type IN ('PAYMENT', 'REFUND') AND namount > 1000 AND NOT isnan(namount) THEN 2 WHEN event_type LIKE 'USER\\_%' ESCAPE '\\' THEN 3
  WHEN event_type IN ('PAGE_VIEW', 'PRODUCT_VIEW') THEN 4 ELSE 3 END"""


@query("event_priority", sql(CP, select=f"SELECT event_type, {_PRIORITY} AS event_priority, count(*) AS messages FROM cp GROUP BY ALL"))
def event_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _commerce(spark, sf_dir)
    return rows.groupBy(F.col("rec.event_type").alias("event_type"), e.event_priority(_rec(rows)).alias("event_priority")).agg(F.count("*").alias("messages"))


_PRESENT = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in ("cob", "user_id", "event_type", "ms", "amount", "quantity", "unit_price", "product_id", "currency", "session_id"))


@query("completeness", sql(CP, select=f"SELECT round(({_PRESENT}) / 10.0, 6) AS completeness, count(*) AS messages FROM cp GROUP BY ALL"))
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _commerce(spark, sf_dir)
    return rows.groupBy(F.round(e.completeness(_rec(rows)), 6).alias("completeness")).agg(F.count("*").alias("messages"))


@query(
    "consistency_score",
    sql(CP, UP, select=f"""
    , s AS (SELECT topic, greatest(0.0::DOUBLE, 1.0::DOUBLE - CASE WHEN event_type = 'PURCHASE' AND amount IS NULL THEN 0.3 ELSE 0 END
        - CASE WHEN abs(996710400000 - ms) > 2592000000 THEN 0.2 ELSE 0 END) AS score FROM cp
      UNION ALL SELECT topic, 1.0::DOUBLE - CASE WHEN event_type = 'PURCHASE' THEN 0.3 ELSE 0 END - CASE WHEN abs({ASOF_MS} - ms) > 2592000000 THEN 0.2 ELSE 0 END FROM up WHERE parse_error IS NULL)
    SELECT topic, round(score, 6) AS consistency_score, count(*) AS messages FROM s GROUP BY ALL"""),
)
def consistency_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    def scores(rows: DataFrame, as_of) -> DataFrame:
        score = F.round(e.consistency_score(_rec(rows), as_of), 6).alias("consistency_score")
        return rows.groupBy("topic", score).agg(F.count("*").alias("messages"))

    users = _users(spark, sf_dir).filter("parse_error is null")
    return scores(_commerce(spark, sf_dir), AS_OF_2001).unionByName(scores(users, AS_OF))


@query(
    "business_flags",
    sql(CP, select="""SELECT event_type, coalesce(namount > 10000 AND NOT isnan(namount), false) AS is_high_value, event_type IN ('PAYMENT', 'LOGIN_FAILED', 'SECURITY_ALERT') AS is_critical_event,
    count(*) AS messages FROM cp GROUP BY ALL"""),
)
def business_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _commerce(spark, sf_dir)
    return rows.groupBy(
        F.col("rec.event_type").alias("event_type"), e.is_high_value().alias("is_high_value"), e.is_critical_event(_rec(rows)).alias("is_critical_event")
    ).agg(F.count("*").alias("messages"))


@query("processing_metadata", sql(OP, select="""SELECT partition, "offset", topic AS processed_topic, cob AS processed_cob, '1.0' AS processing_version FROM oc WHERE reject_rule IS NULL"""))
def processing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.accepted(checked_messages(src.order_envelopes(spark, sf_dir), ORDER_EVENTS, AS_OF_2001))
    return rows.select("partition", "offset", *[c.alias(n) for n, c in e.processing_metadata().items()])


@query(
    "kafka_metadata",
    sql(UE, select="""SELECT topic AS _kafka_topic, partition AS _kafka_partition, "offset" AS _kafka_offset, key AS _kafka_key, '2024-02-01T00:00:00Z' AS _processed_at, '2024-02-01T00:00:00Z' AS _ingestion_timestamp FROM ue"""),
)
def kafka_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.user_event_envelopes(spark, sf_dir).select(*[c.alias(n) for n, c in e.kafka_metadata(AS_OF).items()])


@query(
    "record_metadata",
    sql(UP, select="""
    SELECT partition, "offset", CASE WHEN value IS NULL THEN '{' WHEN doc IS NOT NULL THEN left(value, length(value) - 1) || ',' ELSE '{"original_value":' || CAST(to_json(value) AS VARCHAR) || ',' END
      || '"_metadata":{"processing_timestamp":"2024-02-01T00:00:00Z","kafka_topic":"' || topic || '","kafka_partition":' || partition || ',"kafka_offset":' || "offset"
      || ',"kafka_timestamp":' || (epoch_us(ts) // 1000) || ',"processor_version":"1.0.0"}}' AS record FROM up2"""),
)
def record_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.with_record_metadata(src.user_event_envelopes(spark, sf_dir), AS_OF).select("partition", "offset", "record")


@query(
    "partition_columns",
    sql(CP, select="""SELECT strftime(make_timestamp(ms * 1000), '%Y') AS year, strftime(make_timestamp(ms * 1000), '%m') AS month, strftime(make_timestamp(ms * 1000), '%d') AS day,
    strftime(make_timestamp(ms * 1000), '%H') AS hour, 'unknown' AS region, currency, count(*) AS messages FROM cp GROUP BY ALL"""),
)
def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = parse(src.commerce_envelopes(spark, sf_dir), COMMERCE_EVENTS, AS_OF_2001).select("rec.*")
    names = ("year", "month", "day", "hour", "region", "currency")
    placed = e.partition_columns(flat, names, F.timestamp_millis("timestamp"))
    return placed.groupBy(*names).agg(F.count("*").alias("messages"))


@query(
    "cob_partition_values",
    sql(OP, select="""SELECT left(cob, 4) AS year, substr(cob, 6, 2) AS month, substr(cob, 9, 2) AS day, cob AS cob_date,
    's3://data-lake/orders/lifecycle-events/year=' || left(cob, 4) || '/month=' || substr(cob, 6, 2) || '/day=' || substr(cob, 9, 2) || '/' AS path, count(*) AS messages FROM op GROUP BY ALL"""),
)
def cob_partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse(src.order_envelopes(spark, sf_dir), ORDER_EVENTS, AS_OF_2001)
    values = [c.alias(n) for n, c in e.cob_partition_values().items()]
    return rows.groupBy(*values, e.cob_path(ORDER_EVENTS).alias("path")).agg(F.count("*").alias("messages"))


@query(
    "message_transform",
    sql(OP, select="""SELECT order_id, customer_id, order_status, ms AS timestamp, total_amount, currency, cob, topic AS _kafka_topic, partition AS _kafka_partition, "offset" AS _kafka_offset, key AS _kafka_key,
    '2001-08-02T00:00:00Z' AS _processed_at, '2001-08-02T00:00:00Z' AS _ingestion_timestamp, '2001' AS year, '08' AS month, '02' AS day, len(items) AS n_items FROM op"""),
)
def message_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = e.message_transform(parse(src.order_envelopes(spark, sf_dir), ORDER_EVENTS, AS_OF_2001), ORDER_EVENTS, AS_OF_2001)
    return rows.withColumn("n_items", F.size("items").cast("bigint")).drop("items")


@query(
    "table_rows",
    sql(CC, select=f"""
    SELECT partition AS _kafka_partition, "offset" AS _kafka_offset, event_type, cob AS cob_date, CAST(hour(make_timestamp(ms * 1000)) AS INTEGER) AS hour_of_day, nprice * nquantity AS calculated_total,
      {_PRIORITY} AS event_priority, round(({_PRESENT}) / 10.0, 6) AS completeness, coalesce(namount > 10000 AND NOT isnan(namount), false) AS is_high_value FROM cc WHERE reject_rule IS NULL"""),
)
def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as they are written: parsed, accepted, enriched."""
    rows = e.table_rows(r.accepted(checked_messages(src.commerce_envelopes(spark, sf_dir), COMMERCE_EVENTS, AS_OF_2001)), COMMERCE_EVENTS, AS_OF_2001)
    return rows.select(
        "_kafka_partition", "_kafka_offset", "event_type", "cob_date", "hour_of_day", "calculated_total", "event_priority",
        F.round("completeness", 6).alias("completeness"), "is_high_value",
    )
