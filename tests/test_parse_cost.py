"""What is asked of every message is asked once, and without counting its characters."""

import datetime as dt

from pyspark.sql import functions as F

from weirflow.functions import values
from weirflow.operators.parse import CSV, JSON, detect_format
from weirflow.sources.envelopes import order_envelopes


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_blanks_and_controls_at_both_ends(spark):
    texts = ["a", " a", "a\n", "\x00a\x1f", "é", "é ", " é", "", " ", None, "a b", "日本\t"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", values.trimmed(F.col("t")).alias("out"), values.is_blank(F.col("t")).alias("blank"))
    strip = "".join(map(chr, range(33)))
    assert [(r.t, r.out, r.blank) for r in df.collect()] == [(t, t and t.strip(strip), None if t is None else not t.strip(strip)) for t in texts]


def test_formats(spark):
    said = {'{"a":1}': JSON, ' {"a":1}\n': JSON, "a,b": CSV, "a,b\n": CSV, "[1,2]": JSON, "{a,b": JSON, "a,{}": JSON, "": JSON, "x": JSON}
    df = spark.createDataFrame([(t,) for t in said], "t string").select("t", detect_format(F.col("t")).alias("f"))
    assert {r.t: r.f for r in df.collect()} == said



def test_order_messages_are_compiled(spark, tmp_path):
    rows = [(k, 7, "O", 10.05 * (k + 1), dt.datetime(1996, 1, 2), "1-URGENT") for k in range(200)]
    kinds = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/orders.parquet")
    orders = order_envelopes(spark, str(tmp_path))
    items = [(int(r.key), r.value) for r in orders.collect()]
    assert sorted(value.count('"unit_price"') for _, value in items) == sorted(k % 3 + 1 for k in range(200))
    assert "lambdafunction" not in plan_of(orders)
