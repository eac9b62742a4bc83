import os

from pyspark.sql import functions as F
from weirflow.operators import breaker, sinks


def test_a_frame_of_calls_is_bounded(spark):
    """What a Python worker holds at once is a chunk of calls, whatever their number."""
    calls = spark.range(120_000).select(F.lit("svc").alias("service"), F.col("id").alias("call_id"), F.col("id").alias("at_ms"), (F.col("id") % 7 == 0).alias("failed"))
    _, starts = breaker._started(calls, breaker.b.SERVICE_BREAKER, None, None)
    assert starts.filter(f"{breaker.CHUNK} >= 0").count() >= 3


def test_json_lines_are_packed_and_read_back(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = spark.range(500).select(F.lit("t").alias("topic"), F.concat(F.lit('{"n":'), "id", F.lit(',"note":"the same text in every line"}')).alias("record"))
    sinks.write_jsonl(lines, path, ("topic",))
    files = [f for folder, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    back = sinks.read_jsonl(spark, path, "n bigint, note string, topic string")
    assert sorted(r.n for r in back.collect()) == list(range(500)) and back.filter("topic = 't' and note is not null").count() == 500
