"""Dates, ends of texts and padded numbers are told without patterns, counting or Java's formatter."""

import pytest
from pyspark.sql import functions as F

from weirflow.functions.times import cob_date
from weirflow.functions.values import trimmed
from weirflow.sources.envelopes import _padded, commerce_envelopes

DATES = [
    "2024-02-29", "2023-02-29", "0000-01-01", "9999-12-31", "2024-1-1", "2024-1-01 ", " 2024-1-01", "2024-01-1 ", "2024-01-1T", "2024-01-1:", "12345-1-01",
    "12345-01-1", "+2024-1-01", "-2024-01-0", "+202-01-01", " 202-01-01", "2024-01-01 ", "2024-01-01T", "2024-01-01\n", "2024/01/01", "2024-13-01", "2024-00-10",
    "2024-01-00", "abcd-ef-gh", "２０２-01-01", "202é-01-01", "202-é-01-0", "", " ", None, "2024-01-é", "2024--1-01", "2024-01--1", "2024-01",
]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_business_dates_equal_the_pattern(spark):
    given = spark.createDataFrame([(d,) for d in DATES], "t string")
    strict = F.when(F.col("t").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.col("t").try_cast("date"))
    rows = given.select("t", cob_date(F.col("t")).cast("string").alias("got"), strict.cast("string").alias("want"))
    assert [(r.t, r.got) for r in rows.collect()] == [(r.t, r.want) for r in rows.collect()]
    assert sum(r.got is not None for r in rows.collect()) == 3
    assert "RLIKE" not in plan_of(rows.select("got")).upper()


def test_no_characters_are_counted_to_trim(spark):
    df = spark.createDataFrame([("é \t",), ("日本",), (" ",), ("",)], "t string").select(trimmed(F.col("t")).alias("out"))
    assert [r.out for r in df.collect()] == ["é", "日本", "", ""] and "right(" not in plan_of(df)


@pytest.mark.parametrize("width", [5, 6])
def test_padded_numbers(spark, width):
    numbers = [None, 0, 1, 99_999, 100_000, 999_999, 1_000_000, 9_007_199_254_740_993, -1, -99_999, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint").select(_padded(F.col("n"), width).alias("got"), F.format_string(f"%0{width}d", "n").alias("want"))
    assert [r.got for r in df.collect()] == [r.want for r in df.collect()]


def test_messages_of_the_commerce_topic_keep_their_numbers(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").filter("l_partkey % 37 <> 3 and l_partkey % 31 <> 4")
    want = {tuple(r) for r in lines.select(F.format_string("user-%05d", "l_orderkey"), F.format_string("PROD-%06d", "l_partkey")).collect()}
    body = commerce_envelopes(spark, "/root/testdata/sf0.001").select(F.get_json_object("value", "$.user_id").alias("u"), F.get_json_object("value", "$.product_id").alias("p"))
    assert {(r.u, r.p) for r in body.collect() if r.p and r.p.startswith("PROD")} == want
