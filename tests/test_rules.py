import json
from dataclasses import replace

import pytest
from conftest import NOW
from pyspark.sql import functions as F
from weirflow.config import COMMERCE_EVENTS, USER_EVENTS
from weirflow.operators import enrich
from weirflow.operators import rules as r
from weirflow.operators.jsonschema import ORDER_EVENT_SCHEMA, USER_EVENT_SCHEMA, check_schema, load_schema
from weirflow.operators.parse import parse
from weirflow.plans.flow import checked_messages

NOW_MS = 1706745600000
DAY = 86_400_000
GOOD = {"cob": "2024-01-31", "user_id": "user-0001", "event_type": "LOGIN", "timestamp": NOW_MS - DAY}
BUY = {**GOOD, "event_type": "PURCHASE", "amount": "20.00", "quantity": "2", "unit_price": "10.00", "product_id": "PROD-01"}
PAY = {**GOOD, "event_type": "PAYMENT", "amount": "20.00", "currency": "USD"}

# (base, changed fields, deciding rule or None)
CASES = [
    (GOOD, {}, None),
    (GOOD, {"cob": "2024/01/31"}, "cob_format"), (GOOD, {"cob": "2024-1-31"}, "cob_format"), (GOOD, {"cob": "2024-02-30"}, "cob_format"), (GOOD, {"cob": "2024-01-31\n"}, "cob_format"),
    (GOOD, {"cob": "2024-02-01"}, None), (GOOD, {"cob": "2024-02-02"}, "cob_future"), (GOOD, {"cob": "2019-02-01"}, None), (GOOD, {"cob": "2019-01-31"}, "cob_too_old"),
    (GOOD, {"user_id": None}, "user_id_required"), (GOOD, {"event_type": None}, "event_type_required"), (GOOD, {"user_id": None, "event_type": None}, "user_id_required"),
    (GOOD, {"event_type": "login"}, "event_type_format"), (GOOD, {"event_type": "A1"}, "event_type_format"), (GOOD, {"event_type": "A\n"}, "event_type_format"), (GOOD, {"event_type": ""}, "event_type_format"),
    (GOOD, {"user_id": "user123"}, "user_id_format"), (GOOD, {"user_id": "user1234"}, None), (GOOD, {"user_id": "user_1234"}, "user_id_format"),
    (GOOD, {"timestamp": NOW_MS - 5 * 365 * DAY}, None), (GOOD, {"timestamp": NOW_MS - 5 * 365 * DAY - 1}, "timestamp_too_old"),
    (GOOD, {"timestamp": NOW_MS + DAY}, None), (GOOD, {"timestamp": NOW_MS + DAY + 1}, "timestamp_future"), (GOOD, {"timestamp": None}, None), (GOOD, {"timestamp": 1706745}, "timestamp_too_old"),
    (GOOD, {"amount": "0"}, None), (GOOD, {"amount": "1000000"}, None), (GOOD, {"amount": "1000000.01"}, "amount_limit"), (GOOD, {"amount": "-0.01"}, "amount_negative"),
    (GOOD, {"amount": "NaN"}, None), (GOOD, {"amount": "Infinity"}, "amount_limit"), (GOOD, {"amount": "1d"}, None), (GOOD, {"amount": " 5 "}, None), (GOOD, {"amount": "five"}, "amount_format"), (GOOD, {"amount": ""}, "amount_format"),
    (GOOD, {"quantity": "0"}, None), (GOOD, {"quantity": "10000"}, None), (GOOD, {"quantity": "10001"}, "quantity_limit"), (GOOD, {"quantity": "-1"}, "quantity_negative"),
    (GOOD, {"quantity": "1.0"}, "quantity_format"), (GOOD, {"quantity": " 1 "}, "quantity_format"), (GOOD, {"quantity": "2147483648"}, "quantity_format"),
    (BUY, {}, None), (BUY, {"amount": "20.009"}, None), (BUY, {"amount": "20.02"}, "amount_mismatch"), (BUY, {"amount": None}, None), (BUY, {"unit_price": "ten"}, "unit_price_format"), (BUY, {"amount": "NaN"}, None),
    # 20.01 - 20.0 is a little above 0.01 in binary floating point, as it is for any JVM producer.
    (BUY, {"amount": "20.01"}, "amount_mismatch"),
    (BUY, {"event_type": "ORDER", "amount": "21", "product_id": None}, "amount_mismatch"), (BUY, {"event_type": "REFUNDED", "amount": "21"}, None),
    (BUY, {"product_id": None}, "product_required"), (BUY, {"product_id": "P-123"}, "product_format"), (BUY, {"product_id": "P" * 20}, None), (BUY, {"product_id": "P" * 21}, "product_format"), (BUY, {"product_id": "prod-01"}, "product_format"),
    (GOOD, {"event_type": "USER_ACTION"}, "session_required"), (GOOD, {"event_type": "USER_ACTION", "session_id": "s"}, None),
    (PAY, {}, None), (PAY, {"currency": None}, "money_fields_required"), (PAY, {"amount": None}, "money_fields_required"), (PAY, {"currency": "CHF"}, "currency_code"), (PAY, {"event_type": "REFUND", "currency": "usd"}, "currency_code"),
]


def verdicts(messages, cases):
    df = messages(*[json.dumps({**base, **change}) for base, change in cases], topic=COMMERCE_EVENTS.topic)
    return checked_messages(df, COMMERCE_EVENTS, NOW).orderBy("offset").collect()


def test_every_boundary(messages):
    rows = verdicts(messages, [(b, c) for b, c, _ in CASES])
    wrong = [(c, row.reject_rule, want) for (_, c, want), row in zip(CASES, rows) if row.reject_rule != want]
    assert not wrong


def test_reasons_and_order(messages):
    rows = verdicts(messages, [(GOOD, {"cob": "2030-01-01", "user_id": None}), (PAY, {"currency": "CHF"})])
    assert rows[0].reject_reason == f"cob=2030-01-01, limit={NOW.date()}"
    assert rows[1].reject_reason == "currency=CHF"


def test_all_failures_kept(messages):
    df = parse(messages(json.dumps({**GOOD, "cob": "2030-01-01", "user_id": "x"})), USER_EVENTS, NOW)
    assert r.validate(df, USER_EVENTS, NOW, with_all=True).first().failed_rules == ["cob_future", "user_id_format"]


def test_topic_settings(messages):
    loose = replace(USER_EVENTS, rules=replace(USER_EVENTS.rules, event_type_pattern=r"^[a-z]+\z"))
    df = messages(json.dumps({**GOOD, "event_type": "login"}))
    assert checked_messages(df, loose, NOW).first().reject_rule is None
    extra = r.Rule("no_login", F.col("rec.event_type") == "login", F.lit("no"))
    assert r.validate(parse(df, loose, NOW), loose, NOW, extra=[extra]).first().reject_rule == "no_login"


def test_nothing_is_lost(messages):
    df = messages("", None, "x,y", json.dumps(GOOD), "[", "{}")
    checked = checked_messages(df, USER_EVENTS, NOW)
    assert r.accepted(checked).count() + r.rejected(checked).count() == 6


def enriched(messages, *changes):
    df = messages(*[json.dumps({**GOOD, **c}) for c in changes], topic=COMMERCE_EVENTS.topic)
    return enrich.enrich(parse(df, COMMERCE_EVENTS, NOW), NOW).orderBy("offset").collect()


def test_temporal(messages):
    sunday, monday = enriched(messages, {"timestamp": "2024-03-31T23:59:59Z"}, {"timestamp": "2024-04-01T00:00:00Z"})
    assert (sunday.hour_of_day, sunday.day_of_week, sunday.is_weekend, sunday.quarter) == (23, 7, True, 1)
    assert (monday.hour_of_day, monday.day_of_week, monday.is_weekend, monday.quarter) == (0, 1, False, 2)


def test_priority(messages):
    cases = [("SECURITY_ALERT", None, 1), ("FRAUD_DETECTED", None, 1), ("PAYMENT", "10000", 2), ("PAYMENT", "10000.01", 1), ("REFUND", "1000", 3), ("REFUND", "1000.5", 2), ("PAYMENT", "x", 3), ("USER_X", None, 3), ("PAGE_VIEW", None, 4), ("PRODUCT_VIEW", "1", 4), ("LOGIN", None, 3), (None, None, 3), ("PAYMENT", "NaN", 3)]
    rows = enriched(messages, *[{"event_type": k, "amount": a} for k, a, _ in cases])
    assert [row.event_priority for row in rows] == [p for _, _, p in cases]


def test_scores_and_flags(messages):
    rows = enriched(
        messages, {}, {"event_type": "PURCHASE"}, {"event_type": "USER_ACTION", "user_id": None}, {"timestamp": NOW_MS - 30 * DAY}, {"timestamp": NOW_MS - 30 * DAY - 1},
        {"event_type": "LOGIN_FAILED", "amount": "10000.5", "quantity": "3", "unit_price": "2.5"},
    )
    assert [round(row.consistency_score, 6) for row in rows] == [1.0, 0.7, 0.6, 1.0, 0.8, 1.0]
    assert rows[0].completeness == 0.4 and rows[5].completeness == 0.7
    assert rows[5].is_high_value and rows[5].is_critical_event and rows[5].calculated_total == 7.5
    assert not rows[0].is_high_value and not rows[0].is_critical_event and rows[0].calculated_total is None


def test_partition_columns(spark):
    df = spark.sql("select 'eu' region, cast(null as string) environment, timestamp'2024-03-05 07:00:00' at")
    row = enrich.partition_columns(df, ("YEAR", "month", "day", "hour", "region", "environment", "team"), F.col("at")).first()
    assert (row.year, row.month, row.day, row.hour, row.region, row.environment, row.team) == ("2024", "03", "05", "07", "eu", None, "unknown")


def test_record_metadata(messages):
    rows = enrich.with_record_metadata(messages('{"user_id":"123"}', "simple \"text\"", None, "{ }"), NOW).orderBy("offset").collect()
    docs = [json.loads(row.record) for row in rows]
    assert docs[0]["user_id"] == "123" and docs[0]["_metadata"]["kafka_offset"] == 0 and docs[0]["_metadata"]["processor_version"] == "1.0.0"
    assert docs[1]["original_value"] == 'simple "text"' and list(docs[2]) == ["_metadata"] and list(docs[3]) == ["_metadata"]


def test_enhanced_schema():
    from pyspark.sql import types as T

    name, schema = enrich.enhanced_schema("user", T.StructType([T.StructField("a", T.StringType())]))
    assert name == "user_enhanced" and schema.names == ["a", "_metadata"]
    assert enrich.enhanced_schema("x", T.StringType())[1].names == ["original_value", "_metadata"]
    assert enrich.enhanced_schema("x", None) is None


USER = {"user_id": "u", "event_type": "click", "timestamp": "2024-01-15T10:00:00Z"}


@pytest.mark.parametrize(
    "doc, errors",
    [
        (USER, []),
        ({k: v for k, v in USER.items() if k != "user_id"}, ["$.user_id:required"]),
        ({**USER, "user_id": 12345}, ["$.user_id:type"]),
        ({**USER, "user_id": None}, ["$.user_id:type"]),
        ({**USER, "event_type": "CLICK"}, ["$.event_type:enum"]),
        ({**USER, "timestamp": "2024-01-15"}, ["$.timestamp:format"]),
        ({**USER, "timestamp": "2024-01-15T10:00:00.5+01:00", "page_url": "https://x.example/a"}, []),
        ({**USER, "page_url": "not a url"}, ["$.page_url:format"]),
        ({**USER, "extra": 1}, ["$:additionalProperties"]),
        ({**USER, "properties": {"any": [1]}}, []),
        ({**USER, "properties": []}, ["$.properties:type"]),
    ],
)
def test_user_schema(messages, doc, errors):
    assert check_schema(messages(json.dumps(doc)), USER_EVENT_SCHEMA).first().schema_errors == errors


def test_order_schema(messages):
    order = {"order_id": "o", "customer_id": "c", "order_status": "paid", "timestamp": "2024-01-15T10:00:00Z"}
    item = {"product_id": "p", "quantity": 1, "unit_price": 0}
    docs = [
        ({**order, "items": [item, {**item, "more": 1}], "total_amount": 0, "currency": "EUR"}, []),
        ({**order, "items": [item, {**item, "quantity": 0}]}, ["$.items[].quantity:minimum"]),
        ({**order, "items": [{"product_id": "p", "quantity": 1}]}, ["$.items[].unit_price:required"]),
        ({**order, "items": [{**item, "quantity": 1.5}]}, ["$.items[].quantity:type"]),
        ({**order, "items": ["x"]}, ["$.items[]:type"]),
        ({**order, "items": {}}, ["$.items:type"]),
        ({**order, "total_amount": -0.01, "currency": "EURO"}, ["$.total_amount:minimum", "$.currency:pattern"]),
    ]
    rows = check_schema(messages(*[json.dumps(d) for d, _ in docs]), ORDER_EVENT_SCHEMA).orderBy("offset").collect()
    assert [row.schema_errors for row in rows] == [e for _, e in docs]


def test_missing_schema_file_accepts_objects(messages):
    rows = check_schema(messages('{"any":1}', "[1]", "{broken"), load_schema("/no/such/schema.json")).orderBy("offset").collect()
    assert [row.schema_valid for row in rows] == [True, False, False] and rows[2].schema_errors == ["malformed"]
