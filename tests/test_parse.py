from dataclasses import replace

from conftest import NOW
from pyspark.sql import functions as F
from pyspark.sql import types as T
from weirflow.config import FALLBACK_SCHEMA, ORDER_EVENTS, USER_EVENTS
from weirflow.functions import keys, times, values
from weirflow.operators.parse import detect_format, parse, parse_variant, to_table_rows, wire_header

NOW_MS = 1706745600000


def parsed(df, topic=USER_EVENTS):
    return [r.asDict(recursive=True) for r in parse(df, topic, NOW).orderBy("offset").collect()]


def test_formats(spark):
    cases = {
        '{"a":1}': "JSON", " [1] \n": "JSON", "a,b": "CSV", "a,{b": "JSON", "a,[b": "JSON", "word": "JSON", "": "JSON", "{a},b": "JSON", "\t{}\r\n": "JSON",
    }
    df = spark.createDataFrame([(k,) for k in cases], "value string").withColumn("f", detect_format(F.col("value")))
    assert {r.value: r.f for r in df.collect()} == cases


def test_json_fields_defaults_and_unknown(messages):
    rows = parsed(messages('{"cob":"2024-01-15","user_id":123,"event_type":"LOGIN","timestamp":1705320000000,"x":1,"properties":{"a":1,"b":"t"}}', '{"user_id":null}'))
    assert rows[0]["rec"] == {"cob": "2024-01-15", "user_id": "123", "event_type": "LOGIN", "timestamp": 1705320000000, "data": None, "properties": {"a": "1", "b": "t"}}
    assert rows[1]["rec"]["properties"] == {} and rows[1]["rec"]["user_id"] is None and rows[1]["rec"]["timestamp"] is None
    assert rows[1]["cob"] == "2024-02-01"


def test_invalid_inputs(messages):
    rows = parsed(messages("invalid-json-1", "{incomplete json", "", None, "  \n", "[1,2]", '{"a":1', 'a,"b,c'))
    assert [r["parse_error"] for r in rows] == ["malformed_json", "malformed_json", "empty_message", "null_value", "empty_message", "malformed_json", "malformed_json", "malformed_csv"]


def test_cob_sources(messages):
    rows = parsed(messages('{"cob":"2024-01-15","cob_date":"2023-01-01"}', '{"cob_date":"2024-01-14"}', "{}", "2024-01-13,u", ",u"))
    assert [r["cob"] for r in rows] == ["2024-01-15", "2024-01-14", "2024-02-01", "2024-01-13", "2024-02-01"]


def test_csv_positions_quotes_and_lines(messages):
    rows = parsed(messages('2024-01-15, u1 ,T,5,"a,b"', "2024-01-15,NULL,T", '2024-01-15,u1,T,5,"two\nlines"\nnext,row', "2024-01-15,u,T,7,d,,extra,more", "\n2024-01-15,u2,T"))
    assert rows[0]["rec"]["data"] == "a,b" and rows[0]["rec"]["user_id"] == "u1" and rows[0]["rec"]["timestamp"] == 5
    assert rows[1]["rec"]["user_id"] is None and rows[1]["rec"]["timestamp"] is None
    assert rows[2]["rec"]["data"] == "two\nlines" and rows[2]["rec"]["properties"] == {}
    assert rows[3]["rec"]["timestamp"] == 7 and rows[3]["parse_error"] is None
    assert rows[4]["rec"]["user_id"] == "u2"


def typed(**fields):
    schema = T.StructType([T.StructField("cob", T.StringType(), False)] + [T.StructField(k, v) for k, v in fields.items()])
    return replace(USER_EVENTS, schema=schema)


def test_strict_and_lenient_numbers(messages):
    topic = typed(i=T.IntegerType(), d=T.DoubleType(), b=T.BooleanType())
    texts = ['{"i":5,"d":1.5,"b":true}', '{"i":"x"}', '{"d":"1d"}', '{"i":2147483648}', '{"i":1.5}', '{"b":"yes"}']
    strict = parsed(messages(*texts), topic)
    assert [r["parse_error"] for r in strict] == [None, "bad_field:i", "bad_field:d", "bad_field:i", "bad_field:i", "bad_field:b"]
    lenient = parsed(messages(*texts), replace(topic, lenient=True))
    assert all(r["parse_error"] is None for r in lenient)
    assert [r["rec"]["i"] for r in lenient] == [5, 0, None, 2147483647, 1, None]
    assert lenient[2]["rec"]["d"] == 0.0 and lenient[5]["rec"]["b"] is False


def test_csv_numbers_fail_the_message(messages):
    topic = typed(i=T.IntegerType(), d=T.DoubleType(), b=T.BooleanType())
    rows = parsed(messages("c,5,1.5d,TRUE", "c,5.0,1,x", "c,null,NaN,no", "c,1,abc,"), topic)
    assert rows[0]["rec"] == {"cob": "c", "i": 5, "d": 1.5, "b": True}
    assert rows[1]["parse_error"] == "bad_field:i" and rows[3]["parse_error"] == "bad_field:d"
    assert rows[2]["rec"]["i"] is None and rows[2]["rec"]["d"] != rows[2]["rec"]["d"] and rows[2]["rec"]["b"] is False


def test_nested_items(messages):
    good = '{"order_id":"o","items":[{"product_id":"p","quantity":2,"unit_price":1.5},{"product_id":"q"}]}'
    rows = parsed(messages(good, '{"items":[{"quantity":1.5}]}', '{"items":[]}', topic=ORDER_EVENTS.topic), ORDER_EVENTS)
    assert rows[0]["rec"]["items"] == [{"product_id": "p", "quantity": 2, "unit_price": 1.5}, {"product_id": "q", "quantity": None, "unit_price": None}]
    assert rows[1]["parse_error"] == "bad_field:items" and rows[2]["rec"]["items"] == []


def test_bytes(messages):
    rows = parsed(messages('{"x":"aGVsbG8="}', '{"x":"*"}'), typed(x=T.BinaryType()))
    assert bytes(rows[0]["rec"]["x"]) == b"hello" and rows[1]["parse_error"] == "bad_field:x"


def test_timestamp_cascade(spark):
    cases = {
        "2024-01-15T12:00:00Z": 1705320000000, "2024-01-15T12:00:00.123456Z": 1705320000123, "2024-01-15T14:00:00+02:00": 1705320000000, "1705320000000": 1705320000000,
        "2024-01-15T12:00:00": 1705320000000, "2024-01-15T12:00": 1705320000000, "-5": -5, "2024": 2024, "2024-01-15": NOW_MS, "soon": NOW_MS, "2024-13-15T12:00:00Z": NOW_MS, "": NOW_MS,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").withColumn("ms", times.timestamp_cascade(F.col("t"), NOW))
    assert {r.t: r.ms for r in df.collect()} == cases


def test_trim_controls(spark):
    df = spark.createDataFrame([("\t x \x00",), ("x",), ("  ",), ("\n",), (" \ty",)], "t string")
    assert [r[0] for r in df.select(values.trimmed(F.col("t"))).collect()] == ["x", "x", "", "", "y"]


def test_wire_header(spark):
    import base64

    frames = [base64.b64encode(b"\x00\x00\x00\x01\x02body").decode(), base64.b64encode(b"\x01\x00\x00\x00\x02").decode(), base64.b64encode(b"\x00\x00").decode(), '{"a":1}']
    rows = wire_header(spark.createDataFrame([(f,) for f in frames], "value string")).collect()
    assert [(r.wire_kind, r.schema_id) for r in rows] == [("framed", 258), ("bad_magic", None), ("too_short", None), ("not_base64", None)]
    assert bytes(rows[0].payload) == b"body"


def test_variant_objects_only(messages):
    rows = parse_variant(messages('{"a":{"b":1}}', "[1]", "x", None)).orderBy("offset").select(F.col("doc").isNotNull().alias("o")).collect()
    assert [r.o for r in rows] == [True, False, False, False]


def test_table_rows(messages):
    row = to_table_rows(parse(messages('{"cob":"2024-01-15","user_id":"u"}'), USER_EVENTS, NOW), NOW).first()
    assert row.cob_date == "2024-01-15" and row.processed_timestamp == NOW_MS and row.user_id == "u"


def test_schema_subjects(spark):
    paths = {"schemas/user-events-schema.json": "user-events-value", "orders.avsc": "orders-value", "a/.hidden": ".hidden-value", "x-schema": "x-value", "a/b/c.d-schema.json": "c.d-value"}
    df = spark.createDataFrame([(p,) for p in paths], "p string").withColumn("s", keys.schema_subject(F.col("p")))
    assert {r.p: r.s for r in df.collect()} == paths


def test_partition_keys(spark):
    df = spark.sql("select 'user-events' topic, 5 partition, timestamp'2024-03-10 23:30:00' timestamp union all select 'test-topic', 3, null")
    key = lambda name, zone="UTC": [r[0] for r in df.select(keys.partition_key(name, NOW, zone)).collect()]
    assert key("default") == key("TOPIC_PARTITION") == key("no such") == ["user-events/partition=5", "test-topic/partition=3"]
    assert key("time_based") == ["user-events/year=2024/month=03/day=10/hour=23", "test-topic/year=2024/month=02/day=01/hour=00"]
    assert key("TIME_BASED", "Asia/Tokyo")[0] == "user-events/year=2024/month=03/day=11/hour=08"


def test_fallback_order():
    assert FALLBACK_SCHEMA.names == ["cob", "user_id", "event_type", "timestamp", "data", "properties"]
