"""Plans that must keep their shape: one parse, no needless shuffle, filters at the scan."""

import pytest
from conftest import NOW
from pyspark.sql import functions as F
from weirflow.config import COMMERCE_EVENTS, DEFAULT_TOPICS, ORDER_EVENTS
from weirflow.functions import sides
from weirflow.operators import dedup, sinks
from weirflow.operators.route import route
from weirflow.operators.rules import accepted
from weirflow.plans.flow import accepted_rows, checked_messages
from weirflow.sources.envelopes import ENVELOPE, file_batch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing") / "m")
    spark.createDataFrame([(COMMERCE_EVENTS.topic, 0, 1, None, '{"cob":"2024-01-01"}', NOW, {})], ENVELOPE).write.parquet(path)
    return file_batch(spark, path)


def test_one_parse_and_no_shuffle(landing):
    for topic in (COMMERCE_EVENTS, ORDER_EVENTS):
        text = plan(accepted_rows(landing.filter(F.col("topic") == topic.topic), topic, NOW))
        whole = [line for line in text.splitlines() if "from_json(StructField(cob" in line]
        assert len(whole) == 1 and whole[0].count("from_json(StructField(cob") == 1
        assert "Exchange" not in text and "Python" not in text


def test_routing_moves_no_message_while_topics_are_few(landing, monkeypatch):
    text = plan(route(landing))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    rows = sorted(route(landing).select("topic", "table_name").collect())
    monkeypatch.setattr(sides, "SMALL_ROWS", len(DEFAULT_TOPICS) - 1)
    text = plan(route(landing))
    assert "BroadcastHashJoin" not in text and "Exchange hashpartitioning" in text
    assert sorted(route(landing).select("topic", "table_name").collect()) == rows


def test_topic_filter_reaches_the_scan(landing):
    text = plan(checked_messages(landing, COMMERCE_EVENTS, NOW).filter(F.col("topic") == COMMERCE_EVENTS.topic))
    assert "EqualTo(topic,commerce.events.v1)" in text


def test_unused_envelope_columns_are_not_read(landing):
    text = plan(accepted(checked_messages(landing, COMMERCE_EVENTS, NOW)).groupBy("rec.event_type").count())
    assert "ReadSchema: struct<value:string>" in text


def test_content_dedup_combines_before_the_shuffle(landing):
    text = plan(dedup.dedup_content(landing.select("topic", "partition", "offset", "value"), ["topic"]))
    assert text.index("partial_min_by") > text.index("Exchange hashpartitioning")  # below the exchange in the tree
    assert text.count("Exchange") == 1 and "Window" not in text


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_batch(spark.sql("select id, '2024-01-0' || (id % 3 + 1) cob_date from range(30)"), path, ("cob_date",), 1)
    text = plan(sinks.read_table(spark, path).filter("cob_date = '2024-01-02'"))
    assert "PartitionFilters: [isnotnull(cob_date" in text
