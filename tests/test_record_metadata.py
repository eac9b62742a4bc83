"""Records with metadata: the value is parsed once, and blanks around or inside its braces do no harm."""

import datetime as dt
import json

from pyspark.sql import functions as F

from weirflow.operators import enrich
from weirflow.sources.envelopes import ENVELOPE

AS_OF = dt.datetime(2024, 2, 1)


def records(spark, values):
    rows = [("t", 0, n, None, v, dt.datetime(2024, 1, 1), {}) for n, v in enumerate(values)]
    return enrich.with_record_metadata(spark.createDataFrame(rows, ENVELOPE), AS_OF)


def test_values_keep_their_members_whatever_blanks_they_have(spark):
    values = ['{"a":1}', ' {"a":1} ', '\n{"a":{"b":"\u00e9}"}}\r\n', "{}", "{\n}", " { } ", "[1]", "text", None, '{"a":']
    read = [json.loads(r.record) for r in records(spark, values).orderBy("offset").collect()]
    meta = [r.pop("_metadata") for r in read]
    assert read == [
        {"a": 1}, {"a": 1}, {"a": {"b": "\u00e9}"}}, {}, {}, {}, {"original_value": "[1]"}, {"original_value": "text"}, {}, {"original_value": '{"a":'},
    ]
    assert [m["kafka_offset"] for m in meta] == list(range(len(values)))


def test_a_value_is_parsed_once(spark):
    read = records(spark, ['{"a":1}']).withColumn("read", F.from_json("record", "a int"))
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
