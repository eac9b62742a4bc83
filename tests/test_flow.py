import datetime as dt
import json
import os

import pytest
from conftest import NOW
from pyspark.sql import functions as F
from weirflow.config import COMMERCE_EVENTS, DEFAULT_TOPICS, ORDER_EVENTS, USER_EVENTS, topic_table
from weirflow.operators import dedup, dlq, errors, maintenance, metrics, quality, schemas, sinks
from weirflow.operators.batches import batch_assignment
from weirflow.plans import upkeep
from weirflow.plans.flow import DLQ_PATH, accepted_rows, checked_messages, write_messages
from weirflow.sources import catalog
from weirflow.sources.envelopes import ENVELOPE, file_stream
from weirflow.streaming import ingest as stream

GOOD = {"cob": "2024-01-31", "user_id": "user-0001", "event_type": "LOGIN", "timestamp": 1706659200000}


def rows(n, start=0):
    """Messages of three topics and an unknown one; every fourth is bad."""
    out = []
    for i in range(start, start + n):
        topic = (USER_EVENTS.topic, COMMERCE_EVENTS.topic, "nobody.v1", ORDER_EVENTS.topic)[i % 4]
        body = {"order_id": f"o{i}", "order_status": "paid", "cob": "2024-01-30"} if topic == ORDER_EVENTS.topic else {**GOOD, "cob": f"2024-01-{10 + i % 5}"}
        out.append((topic, i % 2, i, f"k{i}", "{broken" if i % 16 < 4 else json.dumps(body), NOW - dt.timedelta(minutes=i), {}))
    return out


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(rows(160), ENVELOPE)


def lake(spark, root):
    tables = {t.name: sinks.read_table(spark, t.destination.location(root)).count() for t in DEFAULT_TOPICS}
    letters = sinks.read_table(spark, f"{root}/{DLQ_PATH}")
    return tables, {r.dlq_topic: r["count"] for r in letters.groupBy("dlq_topic").count().collect()}


def test_batch_writes_everything_once(spark, batch, tmp_path):
    root = str(tmp_path / "lake")
    write_messages(batch, root, 1, as_of=NOW)
    first = lake(spark, root)
    assert sum(first[0].values()) + sum(first[1].values()) == 160
    assert first[0] == {"user-events": 30, "order-events": 30, "commerce-events": 30}
    assert first[1] == {"user.events.v1-dlq": 10, "commerce.events.v1-dlq": 10, "orders.lifecycle.v2-dlq": 10, "nobody.v1-dlq": 40}
    write_messages(batch, root, 1, as_of=NOW)
    assert lake(spark, root) == first
    write_messages(batch, root, 2, as_of=NOW)
    assert sum(lake(spark, root)[0].values()) == 180


def test_crash_between_the_two_writes(spark, batch, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    from weirflow.plans import flow

    real, calls = flow.write_batch, []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 1:  # the tables are written, the dead letters are not
            raise OSError("storage is gone")
        return real(*args, **kwargs)

    monkeypatch.setattr(flow, "write_batch", failing)
    with pytest.raises(OSError):
        write_messages(batch, root, 5, as_of=NOW)
    monkeypatch.setattr(flow, "write_batch", real)
    write_messages(batch, root, 5, as_of=NOW)
    tables, letters = lake(spark, root)
    assert sum(tables.values()) + sum(letters.values()) == 160


def test_stream_equals_batch_and_restarts(spark, batch, tmp_path):
    source, root, whole = str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "whole")
    write_messages(batch, whole, 1, as_of=NOW)
    start = lambda: stream.ingest(file_stream(spark, source, max_files=1), root, str(tmp_path / "cp"), as_of=NOW, trigger=stream.ALL_AVAILABLE)
    spark.createDataFrame(rows(80), ENVELOPE).coalesce(2).write.parquet(source)
    q = start()
    q.awaitTermination()
    assert stream.run_results(spark, root).agg(F.sum("processed")).first()[0] == 80
    spark.createDataFrame(rows(80, 80), ENVELOPE).coalesce(1).write.mode("append").parquet(source)
    start().awaitTermination()
    start().awaitTermination()
    assert lake(spark, root) == lake(spark, whole)


def test_batch_clock_is_the_newest_message(spark, batch, tmp_path):
    root = str(tmp_path / "lake")
    write_messages(batch, root, 1)
    table = sinks.read_table(spark, USER_EVENTS.destination.location(root))
    assert {r[0] for r in table.select("_processed_at").distinct().collect()} == {"2024-02-01T00:00:00Z"}


def test_jsonl_stream(spark, batch, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "topics")
    batch.write.parquet(source)
    stream.ingest_jsonl(file_stream(spark, source), out, str(tmp_path / "cp"), NOW, "TIME_BASED", stream.ALL_AVAILABLE).awaitTermination()
    back = spark.read.text(out)
    assert back.count() == 160 and {"topic", "year", "month", "day", "hour"} <= set(back.columns)
    report = quality.metadata_quality(back).first()
    assert report.complete_metadata == 160 and report.expected_version == 160 and report.iso_timestamp == 160


def test_dedup_streams(spark, batch, tmp_path):
    source = str(tmp_path / "in")
    batch.unionByName(batch).write.parquet(source)
    for name, make, want in (
        ("offsets", lambda df: dedup.dedup_offset_stream(df), 160),
        ("contents", lambda df: dedup.dedup_content_stream(df, ["topic"]), batch.select("topic", "value").distinct().count()),
    ):
        q = make(file_stream(spark, source)).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(name).count() == want


def test_failure_rate_stream(spark, batch, tmp_path):
    checked = checked_messages(batch.filter(F.col("topic") == USER_EVENTS.topic), USER_EVENTS, NOW).select("topic", "timestamp", "reject_rule")
    checked.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(checked.schema).parquet(str(tmp_path / "in"))
    q = stream.failure_rates(source).writeStream.format("memory").queryName("rates").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    want = metrics.failure_rate_windows(checked, F.col("reject_rule").isNotNull())
    assert sorted(map(tuple, spark.table("rates").collect())) == sorted(map(tuple, want.collect()))


def test_batches_with_a_hot_destination(spark):
    df = spark.range(5000).selectExpr("'user.events.v1' topic", "cast(id % 3 as int) partition", "id div 3 offset")
    got = batch_assignment(df.unionByName(df.limit(10)), chunk=100)
    assert got.count() == 5000
    sizes = {r.batch_no: r["count"] for r in got.groupBy("batch_no").count().collect()}
    assert sizes == {i: 1000 for i in range(5)}
    assert got.filter("batch_no = 0").agg(F.max("partition")).first()[0] == 0


def test_content_dedup_keeps_the_first_copy(spark):
    copies = [("t", 0, i, '{"a": %s}' % (" " * (i % 4) + "1")) for i in range(300)] + [("t", 1, 5, '{"a":2}'), ("t", 1, 6, ' {"a":"x y"} '), ("t", 1, 7, '{"a":"xy"}')]
    got = dedup.dedup_content(spark.createDataFrame(copies, "topic string, partition int, offset long, value string"), ["topic"])
    assert sorted((r.partition, r.offset, r.copies) for r in got.collect()) == [(0, 0, 300), (1, 5, 1), (1, 6, 1), (1, 7, 1)]


def test_duplicate_report_limit(spark):
    make = lambda total, extra: spark.sql(f"select 'user-' || (id % {total - extra}) user_id, 1 timestamp, id offset from range({total})")
    ok = dedup.duplicate_report(make(199, 1), ["offset"]).first()
    assert (ok.total_messages, ok.unique_messages, ok.unique_offsets, ok.duplicate_messages, ok.passed) == (199, 198, 199, 1, True)
    assert dedup.duplicate_report(make(199, 2), ["offset"]).first().passed is False


def test_dead_letters_and_reprocessing(spark, batch):
    checked = checked_messages(batch.filter(F.col("topic") == USER_EVENTS.topic), USER_EVENTS, NOW)
    letters = dlq.dlq_envelope(checked.filter("reject_rule is not null"), NOW)
    assert letters.columns == ["dlq_topic", "original_topic", "original_partition", "original_offset", "original_key", "original_value", "original_timestamp", "error_reason", "error_message", "error_class", "dlq_timestamp", "dlq_version"]
    assert dlq.dlq_stats(letters).first().messages == 10
    again = dlq.dlq_reprocess(letters, USER_EVENTS, NOW, 4)
    assert again.count() == 4 and {r.outcome for r in again.collect()} == {"still_failing"}
    assert json.loads(dlq.dlq_kafka_rows(letters).first().value)["dlq_version"] == "1.0"


@pytest.mark.parametrize(
    "rule_set, kind, message, cause, want",
    [
        ("general", "IOException", None, None, True), ("general", "IllegalStateException", "x", "HTTP 503", True), ("general", "IllegalStateException", "x", "HTTP 404", False), ("general", "X", "Rate Limit", None, True),
        ("table_writer", "IOException", "disk full", None, False), ("table_writer", "IOException", "connection reset", None, True), ("table_writer", "SlowDown", None, None, True), ("table_writer", "X", "try again", None, True),
        ("write_error", "X", "anything", None, True), ("write_error", "X", "schema differs", None, False), ("write_error", "X", "validation timeout", None, True), ("write_error", "X", None, None, True),
        ("listener", "X", "TIMEOUT", None, True), ("listener", "X", "connection", None, False), ("general", "NonRetriableException", "timeout", None, False), ("write_error", "RetriableException", "schema", None, True),
    ],
)
def test_error_rule_sets(spark, rule_set, kind, message, cause, want):
    df = spark.createDataFrame([(kind, message, cause)], "error_class string, error_message string, cause_message string")
    assert errors.classify(df, rule_set).first().retriable is want


def test_retry_delays(spark):
    df = errors.retry_schedule(spark.range(500), "id", 7)
    bounds = df.groupBy("attempt").agg(F.min("delay_ms").alias("lo"), F.max("delay_ms").alias("hi")).orderBy("attempt").collect()
    for r in bounds[:5]:
        plain = 1000 * 2 ** (r.attempt - 1)
        assert plain * 0.875 <= r.lo < r.hi <= plain * 1.125
    assert bounds[6].lo == bounds[6].hi == 30_000
    assert errors.retry_schedule(spark.range(3), "id", 0).count() == 0


def test_health_limits(spark):
    df = spark.createDataFrame([(0.05, 0.0, 100.0, 5000.0), (0.0501, 0.0, 101.0, 1.0), (0.1, 0.0, 1.0, 5001.0), (0.1001, 0.06, None, None)], "failure_rate double, write_failure_rate double, mean_processing_ms double, mean_write_ms double")
    got = [(r.overall_status, r.processing_status, r.storage_status, r.performance_status) for r in metrics.health(df).collect()]
    assert got == [("UP", "UP", "UP", "UP"), ("DEGRADED", "DEGRADED", "UP", "DEGRADED"), ("DEGRADED", "DEGRADED", "UP", "DEGRADED"), ("DOWN", "DOWN", "DEGRADED", "UP")]


def test_quantiles_with_one_hot_value(spark):
    df = spark.sql("select 'a' k, cast(case when id % 3 = 0 then 5 else id end as double) v from range(1000)")
    values = sorted(r.v for r in df.collect())
    got = {r.quantile: r.value for r in metrics.exact_quantiles(df, ["k"], "v").collect()}
    assert got == {q: values[n - 1] for q, n in ((0.5, 500), (0.9, 900), (0.95, 950), (0.99, 990))}


def test_catalog(spark):
    df = spark.createDataFrame([("a-value", 1, 1, "s1"), ("a-value", 2, 3, "s2"), ("b-value", 1, 2, "s1")], catalog.CATALOG)
    assert catalog.latest_of(df, "a-value").first().schema == "s2" and catalog.by_version(df, "a-value", 1).first().schema_id == 1
    assert catalog.by_id(df, 2).first().subject == "b-value" and catalog.subjects(df).count() == 2
    new, known, first = (catalog.register(df, *a).first() for a in (("a-value", "s3"), ("a-value", "s1"), ("c-value", "s1")))
    assert (new.version, new.schema_id, new.is_new) == (3, 4, True) and (known.version, known.schema_id, known.is_new) == (1, 1, False) and (first.version, first.is_new) == (1, True)


def test_inferred_schema(spark):
    df = spark.createDataFrame([('{"a":1,"b":{"c":[1,2]},"d":null,"x":1}',), ('{"a":2.5,"b":{"e":"t"},"x":"s"}',)], "value string")
    schema = schemas.to_struct_type(schemas.inferred_ddl(df).first()[0])
    assert schema.names == ["a", "b", "d", "x"] and schema["x"].dataType.simpleString() == "string" and schema["b"].dataType["c"].dataType.simpleString() == "array<bigint>"


def test_compatibility_modes(spark):
    make = lambda *f: spark.createDataFrame(f, "field string, type string, required boolean")
    old, wider, narrower = make(("a", "BIGINT", True)), make(("a", "DOUBLE", True), ("b", "STRING", False)), make(("a", "BIGINT", True), ("b", "STRING", True))
    check = lambda a, b, mode: schemas.is_compatible(schemas.compatibility(a, b), mode).first().compatible
    assert [check(old, wider, m) for m in ("BACKWARD", "FORWARD", "FULL", "NONE")] == [True, False, False, True]
    assert [check(old, narrower, m) for m in ("BACKWARD", "FORWARD", "FULL")] == [False, True, False]


def test_evolving_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_batch(spark.sql("select 1 a, '2024' year"), path, ("year",), 1)
    sinks.write_batch(spark.sql("select 2 a, 'x' b, '2024' year"), path, ("year",), 2)
    rows_ = sinks.read_table(spark, path, merge_schema=True).orderBy("a").collect()
    assert [(r.a, r.b) for r in rows_] == [(1, None), (2, "x")]


def test_compaction_of_a_table_that_the_flow_wrote(spark, tmp_path):
    root, output = str(tmp_path / "lake"), str(tmp_path / "merged")
    for i in range(4):
        write_messages(spark.createDataFrame(rows(80, 80 * i), ENVELOPE), root, i + 1, as_of=NOW)
    place = ORDER_EVENTS.destination
    table = place.location(root)
    before = upkeep.read_as_text(spark, table, place.partition_columns)
    files = lambda p: sinks.file_inventory(spark, p).filter("path like '%.parquet'").count()
    merged = upkeep.compact(spark, table, output, place.partition_columns)
    key = ["order_id", "year", "month", "day", "order_status"]
    listed = lambda df: sorted(map(tuple, df.select(*key, F.col(sinks.BATCH).cast("long")).collect()))
    assert listed(merged) == listed(before) and merged.count() > 0
    assert {r.month for r in merged.select("month").collect()} == {"01"}
    assert files(output) < files(table)
    closed = upkeep.compact(spark, table, str(tmp_path / "closed"), place.partition_columns, before_batch=3)
    assert {r[0] for r in closed.select(sinks.BATCH).distinct().collect()} == {1, 2}


def test_large_files_are_not_gathered(spark, tmp_path):
    table = str(tmp_path / "t")
    sinks.write_batch(spark.range(20_000).selectExpr("id", "cast(id % 2 as string) p"), table, ("p",), 1)
    merged = upkeep.compact(spark, table, str(tmp_path / "out"), ("p",), target_bytes=100)
    assert merged.count() == 20_000 and merged.agg(F.sum("id")).first()[0] == sum(range(20_000))


def test_maintenance_run(spark, tmp_path):
    root, log, output = str(tmp_path / "lake"), str(tmp_path / "commits"), str(tmp_path / "merged")
    place = ORDER_EVENTS.destination
    table = place.location(root)
    for i in range(5):
        write_messages(spark.createDataFrame(rows(16, 16 * i), ENVELOPE), root, i + 1, as_of=NOW)
        upkeep.record_commit(spark, log, table, "WRITE", NOW + dt.timedelta(minutes=i))
        if i < 4:
            assert upkeep.maintain(spark, table, output, place, log, NOW) == {"VACUUM": False}
    upkeep.record_commit(spark, log, table, "VACUUM", NOW)
    assert upkeep.maintain(spark, table, output, place, log, NOW + dt.timedelta(hours=1)) == {"OPTIMIZE": True}
    assert upkeep.maintain(spark, table, output, place, log, NOW + dt.timedelta(hours=2)) == {}
    for i in range(5):
        upkeep.record_commit(spark, log, "/no/such", "WRITE", NOW + dt.timedelta(minutes=i))
    assert upkeep.maintain(spark, "/no/such", output, place, log, NOW) == {"OPTIMIZE": False, "VACUUM": False}
    assert upkeep.maintain(spark, "/no/such", output, place, log, NOW)["OPTIMIZE"] is False  # not recorded, so tried again


def test_a_hot_partition_gets_the_bins_of_a_plain_running_sum(spark):
    files = spark.range(12_000).selectExpr("'t' table_path", "if(id % 6 = 0, 'cold-' || (id % 30), 'hot') partition", "'f' || lpad(id, 9, '0') path", "cast(10 + id % 7 as bigint) size")
    plan = maintenance.compaction_plan(files, target_bytes=100, rows_per_chunk=500)
    want, sizes = {}, {}
    for r in sorted(files.collect(), key=lambda r: (r.partition, r.path)):
        want[r.path] = sizes.get(r.partition, 0) // 100
        sizes[r.partition] = sizes.get(r.partition, 0) + r.size
    assert {r.path: r.bin_no for r in plan.collect()} == want


def test_due(spark):
    settings = topic_table(spark)
    path = ORDER_EVENTS.destination.location()
    commits = lambda n, vacuum: spark.createDataFrame([(path, NOW - dt.timedelta(days=30), "OPTIMIZE")] + [(path, NOW - dt.timedelta(hours=i), "WRITE") for i in range(n)] + ([(path, vacuum, "VACUUM")] if vacuum else []), "table_path string, committed_at timestamp, operation string")
    stats = lambda n, v=None: maintenance.maintenance_stats(commits(n, v))
    assert [maintenance.optimize_due(stats(n), settings).first().due for n in (4, 5)] == [False, True]
    due = [maintenance.vacuum_due(stats(1, v), settings, NOW).first().due for v in (None, NOW - dt.timedelta(hours=168), NOW - dt.timedelta(hours=167))]
    assert due == [True, True, False]


def test_writer_stats_and_layout(spark, batch, tmp_path):
    path = str(tmp_path / "t")
    data = accepted_rows(batch.filter(F.col("topic") == USER_EVENTS.topic), USER_EVENTS, NOW)
    sinks.append_table(data, path, ("cob_date",))
    stats = sinks.writer_stats(sinks.read_table(spark, path), ["cob_date"])
    assert stats.agg(F.sum("records")).first()[0] == 30 and stats.filter("bytes <= 0 or files < 1").count() == 0
    assert quality.missing_columns(sinks.read_table(spark, path), quality.USER_TABLE_COLUMNS) == ["year", "month", "day"]
    report = quality.layout_report(sinks.file_inventory(spark, path).filter("path like '%.parquet'"), 1).first()
    assert report.data_files >= 5 and report.directories == 5


def test_any_number_of_topics(spark):
    from dataclasses import replace

    many = tuple(replace(USER_EVENTS, topic=f"t{k}") for k in range(12_000))
    assert topic_table(spark, many).count() == 12_000


def test_batch_clock_is_bounded_by_the_start_of_the_batch(spark):
    from weirflow.plans.flow import batch_clock

    start = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp")
    at = lambda *times: batch_clock(spark.createDataFrame([(t,) for t in times], "timestamp timestamp"), start)
    assert at(dt.datetime(2024, 1, 3), None) == dt.datetime(2024, 1, 3)
    assert at(dt.datetime(2099, 1, 1), dt.datetime(2024, 1, 3)) == dt.datetime(2024, 2, 1)
    assert at(None) == dt.datetime(2024, 2, 1)
    assert at() > dt.datetime(2024, 2, 1)  # no messages: the present


def test_long_retries_do_not_overflow(spark):
    schedule = errors.retry_schedule(spark.range(1), "id", 70)
    delays = [r.delay_ms for r in schedule.orderBy("attempt").collect()]
    assert len(delays) == 70 and set(delays[10:]) == {30_000}


def test_field_names_that_hold_type_words(spark):
    schema = schemas.to_struct_type("OBJECT<AVOIDED: STRING, VARIANT_ID: BIGINT, VOID: VOID, `a: VOID`: ARRAY<VARIANT>, o: OBJECT<OBJECT: VARIANT>>")
    assert schema.simpleString() == "struct<AVOIDED:string,VARIANT_ID:bigint,VOID:string,a: VOID:array<string>,o:struct<OBJECT:string>>"


def test_quantiles_of_a_narrow_range_of_a_hot_key(spark):
    df = spark.range(30_000).selectExpr("if(id % 10 = 0, 'cold', 'hot') k", "(id % 7919) / 100000.0D v")
    got = {(r.k, r.quantile): r.value for r in metrics.exact_quantiles(df, ["k"], "v", rows_per_bin=700).collect()}
    values = {}
    for r in df.collect():
        values.setdefault(r.k, []).append(r.v)
    for k, own in values.items():
        own.sort()
        for q in metrics.QUANTILES:
            assert got[k, q] == own[-(-int(q * 10_000) * len(own) // 10_000) - 1]


def test_second_deliveries_are_dropped_when_a_topic_asks(spark, batch, tmp_path):
    from dataclasses import replace

    for by in ("offset", "content"):
        root = str(tmp_path / by)
        topics = tuple(replace(t, processing=replace(t.processing, dedup=by)) for t in DEFAULT_TOPICS)
        write_messages(batch.unionByName(batch), root, 1, topics, as_of=NOW)
        tables, _ = lake(spark, root)
        assert tables["user-events"] == (30 if by == "offset" else 5)  # five different bodies


def test_second_deliveries_across_batches_of_a_stream(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "lake")
    start = lambda: stream.ingest(file_stream(spark, source, max_files=1), root, str(tmp_path / "cp"), as_of=NOW, trigger=stream.ALL_AVAILABLE, dedup="offset")
    for _ in range(2):
        spark.createDataFrame(rows(80), ENVELOPE).coalesce(1).write.mode("append").parquet(source)
        start().awaitTermination()
    tables, letters = lake(spark, root)
    assert sum(tables.values()) + sum(letters.values()) == 80


def test_a_schema_file_is_checked(spark, tmp_path):
    from dataclasses import replace

    path = tmp_path / "s.json"
    path.write_text(json.dumps({"type": "object", "properties": {"user_id": {"type": "string", "pattern": "^user-"}, "level": {"enum": [1, 2.5, None, True, "x"]}, "big": {"type": "integer"}}}))
    topic = replace(USER_EVENTS, schema_file=f"file://{path}")
    bodies = [{}, {"user_id": "nobody-1"}, {"level": 2}, {"level": 1}, {"level": 2.5}, {"level": None}, {"level": True}, {"level": "x"}, {"big": 12345678901234567890}, {"big": 1.5}]
    data = [(USER_EVENTS.topic, 0, i, None, json.dumps({**GOOD, **b}), NOW, {}) for i, b in enumerate(bodies)]
    checked = checked_messages(spark.createDataFrame(data, ENVELOPE), topic, NOW).orderBy("offset").collect()
    assert [r.reject_rule == "json_schema" for r in checked] == [False, True, True, False, False, False, False, False, False, True]
    missing = replace(USER_EVENTS, schema_file=f"file://{tmp_path}/none.json")
    assert "json_schema" not in {r.reject_rule for r in checked_messages(spark.createDataFrame(data, ENVELOPE), missing, NOW).collect()}
