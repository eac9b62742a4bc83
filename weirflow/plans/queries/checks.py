"""JSON Schema checks and business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.config import COMMERCE_EVENTS, ORDER_EVENTS, USER_EVENTS
from weirflow.operators import rules as r
from weirflow.operators.jsonschema import ORDER_EVENT_SCHEMA, USER_EVENT_SCHEMA, check_schema
from weirflow.operators.parse import parse
from weirflow.plans.flow import checked_messages
from weirflow.plans.queries.messages_sql import (
    ASOF, ASOF_2001_MS, ASOF_MS, CC, COB_CASES, CONDITIONAL_CASES, CP, CROSS_CASES, NUMERIC_CASES, OE, OP, PE, UC, UP, sql,
)
from weirflow.plans.queries.registry import AS_OF, AS_OF_2001, query
from weirflow.sources import envelopes as src


def _parsed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF).filter("parse_error is null")


def _parsed_commerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(src.commerce_envelopes(spark, sf_dir), COMMERCE_EVENTS, AS_OF_2001)


def _verdicts(parsed: DataFrame, rules: list[r.Rule], *columns: str) -> DataFrame:
    """Messages per verdict of a group of rules (and per further columns)."""
    checked = r.apply_rules(parsed, rules)
    verdict = F.coalesce("reject_rule", F.lit("accepted")).alias("rule")
    return checked.groupBy(*columns, verdict).agg(F.count("*").alias("messages"))


_USER_ERRORS = """
, d AS (SELECT partition, "offset", CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS doc FROM pe),
e AS (SELECT partition, "offset", doc, json_type(doc) = 'OBJECT' AS obj FROM d),
f AS (SELECT partition, "offset", CASE WHEN doc IS NULL THEN ['malformed'] ELSE list_filter([
  CASE WHEN NOT obj THEN '$:type' END,
  CASE WHEN obj AND json_extract(doc, '$.user_id') IS NULL THEN '$.user_id:required' END,
  CASE WHEN obj AND json_extract(doc, '$.event_type') IS NULL THEN '$.event_type:required' END,
  CASE WHEN obj AND json_extract(doc, '$.timestamp') IS NULL THEN '$.timestamp:required' END,
  CASE WHEN obj AND len(list_filter(json_keys(doc), lambda x: x NOT IN ('user_id', 'event_type', 'timestamp', 'page_url', 'session_id', 'properties'))) > 0 THEN '$:additionalProperties' END,
  CASE WHEN json_type(doc, '$.user_id') <> 'VARCHAR' THEN '$.user_id:type' END,
  CASE WHEN json_type(doc, '$.event_type') <> 'VARCHAR' THEN '$.event_type:type' END,
  CASE WHEN json_extract_string(doc, '$.event_type') NOT IN ('click', 'view', 'signup', 'login', 'logout') THEN '$.event_type:enum' END,
  CASE WHEN json_type(doc, '$.timestamp') <> 'VARCHAR' THEN '$.timestamp:type' END,
  CASE WHEN json_extract_string(doc, '$.timestamp') NOT LIKE '%Z' THEN '$.timestamp:format' END,
  CASE WHEN json_type(doc, '$.page_url') <> 'VARCHAR' THEN '$.page_url:type' END,
  CASE WHEN json_extract_string(doc, '$.page_url') LIKE '% %' THEN '$.page_url:format' END,
  CASE WHEN json_type(doc, '$.session_id') <> 'VARCHAR' THEN '$.session_id:type' END,
  CASE WHEN json_type(doc, '$.properties') <> 'OBJECT' THEN '$.properties:type' END], lambda x: x IS NOT NULL) END AS errors FROM e)
SELECT partition, "offset", len(errors) = 0 AS schema_valid, array_to_string(errors, '|') AS errors FROM f"""


@query("jsonschema_user", sql(PE, select=_USER_ERRORS))
def jsonschema_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_schema(src.page_event_envelopes(spark, sf_dir), USER_EVENT_SCHEMA)
    return checked.select("partition", "offset", "schema_valid", F.array_join("schema_errors", "|").alias("errors"))


@query("jsonschema_permissive", sql(PE, select="""
    , d AS (SELECT partition, "offset", CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS doc FROM pe)
    SELECT partition, "offset", doc IS NOT NULL AND json_type(doc) = 'OBJECT' AS schema_valid FROM d"""))
def jsonschema_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a schema file any JSON object passes."""
    return check_schema(src.page_event_envelopes(spark, sf_dir), None).select("partition", "offset", "schema_valid")


_ORDER_ERRORS = """
, d AS (SELECT partition, "offset", CAST(CASE WHEN "offset" % 61 = 1 THEN value ELSE regexp_replace(value, '"cob":"[^"]*",', '') END AS JSON) AS doc FROM oe),
i AS (SELECT *, json_extract(doc, '$.items[*]') AS items FROM d),
f AS (SELECT partition, "offset", list_filter([
  CASE WHEN json_extract(doc, '$.customer_id') IS NULL THEN '$.customer_id:required' END,
  CASE WHEN json_extract(doc, '$.cob') IS NOT NULL THEN '$:additionalProperties' END,
  CASE WHEN json_extract_string(doc, '$.order_status') NOT IN ('created', 'paid', 'shipped', 'delivered', 'cancelled') THEN '$.order_status:enum' END,
  CASE WHEN json_extract_string(doc, '$.timestamp') NOT LIKE '%T%' THEN '$.timestamp:format' END,
  CASE WHEN json_type(doc, '$.total_amount') = 'VARCHAR' THEN '$.total_amount:type' END,
  CASE WHEN json_type(doc, '$.total_amount') <> 'VARCHAR' AND CAST(json_extract_string(doc, '$.total_amount') AS DOUBLE) < 0 THEN '$.total_amount:minimum' END,
  CASE WHEN NOT regexp_full_match(json_extract_string(doc, '$.currency'), '[A-Z]{3}') THEN '$.currency:pattern' END,
  CASE WHEN len(list_filter(items, lambda x: json_extract(x, '$.quantity') IS NULL)) > 0 THEN '$.items[].quantity:required' END,
  CASE WHEN len(list_filter(items, lambda x: json_type(x, '$.quantity') = 'DOUBLE')) > 0 THEN '$.items[].quantity:type' END,
  CASE WHEN len(list_filter(items, lambda x: CAST(json_extract_string(x, '$.quantity') AS DOUBLE) < 1)) > 0 THEN '$.items[].quantity:minimum' END], lambda x: x IS NOT NULL) AS errors FROM i)
SELECT partition, "offset", len(errors) = 0 AS schema_valid, array_to_string(errors, '|') AS errors FROM f"""


@query("jsonschema_order", sql(OE, select=_ORDER_ERRORS))
def jsonschema_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = F.when(F.col("offset") % 61 == 1, F.col("value")).otherwise(F.regexp_replace("value", r'"cob":"[^"]*",', ""))
    checked = check_schema(src.order_envelopes(spark, sf_dir).withColumn("value", bare), ORDER_EVENT_SCHEMA)
    return checked.select("partition", "offset", "schema_valid", F.array_join("schema_errors", "|").alias("errors"))


@query("cob_checks", sql(UP, select=f"""SELECT CASE {COB_CASES.format(asof=ASOF)} ELSE 'accepted' END AS rule, cob, count(*) AS messages FROM up WHERE parse_error IS NULL GROUP BY ALL"""))
def cob_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(r.with_numbers(_parsed_users(spark, sf_dir)), r.cob_rules(AS_OF, USER_EVENTS.rules), "cob")


@query(
    "required_fields",
    sql(UP, select="""SELECT format, CASE WHEN user_id IS NULL THEN 'user_id_required' WHEN event_type IS NULL THEN 'event_type_required' ELSE 'accepted' END AS rule, count(*) AS messages
    FROM up WHERE parse_error IS NULL GROUP BY ALL"""),
)
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed_users(spark, sf_dir)
    return _verdicts(parsed, r.required_rules(parsed.schema["rec"].dataType, USER_EVENTS.rules), "format")


@query(
    "format_rules",
    sql(UP, select="""SELECT event_type, CASE WHEN NOT regexp_full_match(event_type, '[A-Z_]+') THEN 'event_type_format' WHEN NOT regexp_full_match(user_id, '[a-zA-Z0-9-]{8,}') THEN 'user_id_format'
    ELSE 'accepted' END AS rule, count(*) AS messages FROM up WHERE parse_error IS NULL GROUP BY ALL"""),
)
def format_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed_users(spark, sf_dir)
    return _verdicts(parsed, r.format_rules(parsed.schema["rec"].dataType, USER_EVENTS.rules), F.col("rec.event_type").alias("event_type"))


@query(
    "timestamp_range",
    sql(UP, CP, select=f"""
    , t AS (SELECT topic, ms, CAST({ASOF_MS} AS BIGINT) AS now FROM up WHERE parse_error IS NULL UNION ALL SELECT topic, ms, {ASOF_2001_MS} FROM cp)
    SELECT topic, CASE WHEN ms < now - 157680000000 THEN 'timestamp_too_old' WHEN ms > now + 86400000 THEN 'timestamp_future' ELSE 'accepted' END AS rule, count(*) AS messages FROM t GROUP BY ALL"""),
)
def timestamp_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, commerce = _parsed_users(spark, sf_dir), _parsed_commerce(spark, sf_dir)
    a = _verdicts(users, r.timestamp_rules(users.schema["rec"].dataType, AS_OF, USER_EVENTS.rules), "topic")
    b = _verdicts(commerce, r.timestamp_rules(commerce.schema["rec"].dataType, AS_OF_2001, COMMERCE_EVENTS.rules), "topic")
    return a.unionByName(b)


def _commerce_group(spark: SparkSession, sf_dir: str, rules) -> DataFrame:
    parsed = r.with_numbers(_parsed_commerce(spark, sf_dir))
    chosen = rules(parsed.schema["rec"].dataType, COMMERCE_EVENTS.rules)
    return _verdicts(parsed, chosen, F.col("rec.event_type").alias("event_type"))


@query("numeric_ranges", sql(CP, select=f"SELECT event_type, CASE {NUMERIC_CASES} ELSE 'accepted' END AS rule, count(*) AS messages FROM cp GROUP BY ALL"))
def numeric_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _commerce_group(spark, sf_dir, r.numeric_rules)


@query("cross_field_amount", sql(CP, select=f"SELECT event_type, CASE {CROSS_CASES} ELSE 'accepted' END AS rule, count(*) AS messages FROM cp GROUP BY ALL"))
def cross_field_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _commerce_group(spark, sf_dir, r.cross_field_rules)


@query("conditional_required", sql(CP, select=f"SELECT event_type, CASE {CONDITIONAL_CASES} ELSE 'accepted' END AS rule, count(*) AS messages FROM cp GROUP BY ALL"))
def conditional_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _commerce_group(spark, sf_dir, r.conditional_rules)


@query(
    "validation_summary",
    sql(UC, CC, OP, select="""
    , v AS (SELECT topic, reject_rule FROM uc UNION ALL SELECT topic, reject_rule FROM cc UNION ALL SELECT topic, reject_rule FROM oc)
    SELECT topic, coalesce(reject_rule, 'accepted') AS rule, count(*) AS messages FROM v GROUP BY ALL"""),
)
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of the three topics and the first rule it breaks."""
    parts = [
        r.validation_summary(checked_messages(make(spark, sf_dir), topic, as_of))
        for make, topic, as_of in (
            (src.user_event_envelopes, USER_EVENTS, AS_OF),
            (src.commerce_envelopes, COMMERCE_EVENTS, AS_OF_2001),
            (src.order_envelopes, ORDER_EVENTS, AS_OF_2001),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "all_failed_rules",
    sql(CP, select="""
    SELECT event_type, array_to_string(list_filter([
        CASE WHEN amount IS NOT NULL AND namount IS NULL THEN 'amount_format' END, CASE WHEN namount < 0 THEN 'amount_negative' END,
        CASE WHEN namount > 1000000 AND NOT isnan(namount) THEN 'amount_limit' END, CASE WHEN quantity IS NOT NULL AND nquantity IS NULL THEN 'quantity_format' END,
        CASE WHEN nquantity < 0 THEN 'quantity_negative' END, CASE WHEN nquantity > 10000 THEN 'quantity_limit' END,
        CASE WHEN event_type IN ('PURCHASE', 'ORDER') AND abs(namount - nquantity * nprice) > 0.01 AND NOT isnan(namount) THEN 'amount_mismatch' END], lambda x: x IS NOT NULL), '|') AS failed, count(*) AS messages
    FROM cp GROUP BY ALL"""),
)
def all_failed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = r.with_numbers(_parsed_commerce(spark, sf_dir))
    rec, s = parsed.schema["rec"].dataType, COMMERCE_EVENTS.rules
    checked = r.apply_rules(parsed, [*r.numeric_rules(rec, s), *r.cross_field_rules(rec, s)], with_all=True)
    return checked.groupBy(F.col("rec.event_type").alias("event_type"), F.array_join("failed_rules", "|").alias("failed")).agg(F.count("*").alias("messages"))
