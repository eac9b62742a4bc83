import datetime as dt
import json
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from weirflow.config import USER_EVENTS
from weirflow.functions.breaker import BreakerSettings
from weirflow.operators import breaker, lattice, retries, seen, sinks, sketches
from weirflow.plans import flow, ledger
from weirflow.plans.queries.delivery import many_topics
from weirflow.sources.envelopes import ENVELOPE, file_stream
from weirflow.streaming import ingest as stream

NOW = dt.datetime(2024, 2, 1)
BODY = {"cob": "2024-01-30", "user_id": "user-00001", "event_type": "LOGIN", "timestamp": 1706600000000}


def messages(spark, values, topics=(USER_EVENTS.topic,)):
    return spark.createDataFrame([(topics[i % len(topics)], i % 3, i, f"k{i}", v, NOW - dt.timedelta(minutes=i), {}) for i, v in enumerate(values)], ENVELOPE)


def good(**more):
    return json.dumps({**BODY, **more})


# ---- many destinations ----------------------------------------------------------------------


def jobs_of(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_follow_the_number_of_topics(spark, tmp_path):
    counts = []
    for n in (2, 40):
        topics = many_topics(n)
        batch = messages(spark, [good(data=str(i)) if i % 7 else "{" for i in range(200)], [t.topic for t in topics])
        counts.append(jobs_of(spark, lambda: flow.write_messages(batch, str(tmp_path / f"lake{n}"), 1, topics, NOW)))
        for t in (topics[0], topics[-1]):
            mine = sinks.read_table(spark, t.destination.location(str(tmp_path / f"lake{n}")))
            assert {r[0] for r in mine.select("_kafka_topic").distinct().collect()} == {t.topic}
    assert counts[0] == counts[1] > 0


def test_topics_that_differ_are_parsed_apart():
    a, b = many_topics(2)
    assert [len(g) for g in flow.destination_groups((a, b))] == [2]
    assert [len(g) for g in flow.destination_groups((a, replace(b, lenient=True)))] == [1, 1]
    with pytest.raises(ValueError):
        replace(a.destination, table_name="../x").location("/lake")


# ---- ledgers --------------------------------------------------------------------------------


def test_a_batch_that_throws_leaves_a_failed_run_and_then_a_good_one(spark, tmp_path, monkeypatch):
    source, root, offsets = (str(tmp_path / n) for n in ("in", "lake", "cp"))
    messages(spark, [good(), "{", good()]).coalesce(1).write.parquet(source)
    real = stream.write_messages

    def broken(*args, **kwargs):
        raise OSError("storage is gone")

    start = lambda: stream.ingest(file_stream(spark, source), root, offsets, (USER_EVENTS,), NOW, stream.ALL_AVAILABLE)
    monkeypatch.setattr(stream, "write_messages", broken)
    with pytest.raises(Exception, match="storage is gone"):
        start().awaitTermination()
    failed = ledger.run_results(spark, root).collect()
    assert [(r.batch_id, r.topic, r.success, r.processed) for r in failed] == [(0, None, False, 0)] and "storage is gone" in failed[0].error_message
    monkeypatch.setattr(stream, "write_messages", real)
    start().awaitTermination()
    runs = sorted(ledger.run_results(spark, root).collect(), key=lambda r: r.success)
    assert [(r.success, r.topic, r.processed, r.failed) for r in runs] == [(False, None, 0, 0), (True, USER_EVENTS.topic, 3, 1)]
    assert all(r.ended_at >= r.started_at and r.duration_ms >= 0 for r in runs)


def test_files_are_recorded_once_and_maintenance_runs_after_a_flush(spark, tmp_path):
    source, root, offsets = (str(tmp_path / n) for n in ("in", "lake", "cp"))
    place = replace(USER_EVENTS.destination, options=replace(USER_EVENTS.destination.options, optimize_interval=2))
    topics = (replace(USER_EVENTS, destination=place),)
    for part in range(2):
        messages(spark, [good(data=f"{part}-{i}") for i in range(6)]).coalesce(1).write.mode("append").parquet(source)
        stream.ingest(file_stream(spark, source, max_files=1), root, offsets, topics, NOW, stream.ALL_AVAILABLE).awaitTermination()
    known = ledger.inventory(spark, root, place.table_name)
    listed = sinks.file_inventory(spark, place.location(root)).filter(F.col("path").endswith(".parquet"))
    assert {tuple(r) for r in known.select("path", "size").collect()} == {tuple(r) for r in listed.select("path", "size").collect()}
    assert known.agg(F.sum("rows")).first()[0] == 12
    assert sinks.read_table(spark, f"{root}/compacted/{place.table_name}").count() == 12
    commits = spark.read.parquet(f"{root}/commits").groupBy("operation").count()
    assert {r[0]: r[1] for r in commits.collect()} == {"WRITE": 2, "OPTIMIZE": 1}
    ledger.record_files(spark, root, 1, NOW)  # as if the batch ran again
    assert ledger.inventory(spark, root).agg(F.sum("rows")).first()[0] == 12
    assert ledger.record_files(spark, root, 99, NOW) == []


# ---- an index of contents -------------------------------------------------------------------


def test_contents_are_taken_in_once_over_jobs(spark, tmp_path):
    index = str(tmp_path / "index")
    taken = lambda values, job, days: sorted((r.value or "") for r in seen.take_in(messages(spark, values), index, job, NOW + dt.timedelta(days=days)).collect())
    assert taken(["a", "b", "a", None], 1, 0) == ["", "a", "b"]
    assert taken(["b", '{"x":1}', None], 2, 1) == ['{"x":1}']
    assert taken(["b", '{"x":1}', None], 2, 1) == ['{"x":1}']  # the same job again
    assert taken([' { "x" : 1 } ', "c", ""], 3, 2) == ["", "c"]
    assert taken(["a", "c"], 4, 8) == ["a"]  # seven days later only the first day is forgotten
    assert [r.day for r in seen.expired_days(spark, index, NOW + dt.timedelta(days=8)).collect()] == [NOW.date()]
    assert seen.take_in(messages(spark, ["a"]).filter("false"), index, 5, NOW).count() == 0


def test_contents_of_two_topics_do_not_meet(spark, tmp_path):
    both = messages(spark, ["a", "a", "a"], ("one", "two"))
    assert sorted((r.topic, r.copies) for r in seen.take_in(both, str(tmp_path / "i"), 1, NOW).collect()) == [("one", 2), ("two", 1)]


# ---- retries --------------------------------------------------------------------------------


def test_rounds_equal_a_plain_simulation(spark, tmp_path):
    letters = flow.dead_letters(messages(spark, [good(event_type=f"bad-{i}") for i in range(20)] + ["{"]), USER_EVENTS, NOW)
    letters = letters.union(letters)  # every letter twice
    relaxed = replace(USER_EVENTS, rules=replace(USER_EVENTS.rules, event_type_pattern=r"^.*[02468]\z"))
    path, state, log = str(tmp_path / "ledger"), {}, []
    waits = {}
    for number, seconds in ((1, 0), (2, 1), (3, 2), (4, 60), (5, 61), (6, 900)):
        at = NOW + dt.timedelta(seconds=seconds)
        ms = int(at.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        tried = {r.offset: (r.attempt, r.outcome) for r in retries.retry_round(letters, path, number, relaxed, at, 3).collect()}
        want = {}
        for i in range(21):
            attempt, outcome = state.get(i, (0, None))
            if outcome in (None, "still_failing") and (outcome is None or waits[i] <= ms):
                fine = i < 20 and i % 2 == 0
                want[i] = (attempt + 1, "accepted" if fine else "given_up" if attempt + 1 >= 3 else "still_failing")
        assert tried == want
        state.update(want)
        waits.update({r.original_offset: r.due_ms for r in retries.ledger_rows(spark, path).filter(f"round = {number}").collect()})
        log.append(len(want))
    assert log[0] == 21 and log[-1] == 0 and {o for _, o in state.values()} == {"accepted", "given_up"}
    assert retries.open_letters(letters, path).count() == 0
    assert retries.ledger_rows(spark, path, 2).count() == 21


# ---- breakers over batches ------------------------------------------------------------------


def test_breakers_go_on_where_the_batch_before_left_them(spark):
    import random

    rng = random.Random(3)
    rows = [(f"s{rng.randrange(3)}", i, i * 400, rng.random() < 0.6, rng.random() < 0.7) for i in range(300)] + [("quiet", 1000, 1, True, True)]
    calls = spark.createDataFrame(rows, "service string, call_id long, at_ms long, failed boolean, trips boolean")
    settings = BreakerSettings(failure_threshold=3, open_ms=5_000, success_threshold=2)
    whole = sorted(map(tuple, breaker.breaker_replay(calls, settings, chunks=3).collect()))
    early, late = calls.filter("at_ms < 60000"), calls.filter("at_ms >= 60000")
    ends = breaker.breaker_ends(early, settings)
    parts = breaker.breaker_replay(early, settings, chunks=2).union(breaker.breaker_replay(late, settings, chunks=4, before=ends))
    assert sorted(map(tuple, parts.collect())) == whole
    last = {r.service: (r.kind, r.amount) for r in breaker.breaker_ends(late, settings, before=ends).collect()}
    assert last["quiet"] == (0, 1) and set(last) == {"s0", "s1", "s2", "quiet"}


# ---- sketches -------------------------------------------------------------------------------


def test_merged_sketches_keep_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"), (F.col("id") % 200).alias("w"))
    short = sketches.quantile_sketches(df, ["k"], F.col("w"), "v")
    got = sketches.quantiles_of(sketches.merged_quantiles(short, ["k"]), (0.5, 0.99)).collect()
    assert {(r.k, r.quantile) for r in got} == {(0, 0.5), (0, 0.99), (1, 0.5), (1, 0.99)}
    assert all(abs(r.value / 60_000 - r.quantile) < 0.02 and r.n == 30_000 for r in got)
    hours = sketches.distinct_sketches(df.withColumn("u", F.col("v") % 20_000), ["k"], F.col("w"), "u")
    total = sketches.union_of(hours, ["k"]).select("rows", F.theta_sketch_estimate("sketch").alias("n")).collect()
    assert all(r.rows == 30_000 and abs(r.n - 10_000) < 300 for r in total)
    assert sketches.quantiles_of(sketches.quantile_sketches(df.limit(0), ["k"], F.col("w"), "v"), (0.5,)).count() == 0


# ---- schemas in depth -----------------------------------------------------------------------


def typed(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    "a,b,want",
    [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("int", "float", "double"), ("double", "string", "string"), ("boolean", "int", "string"),
        ("array<int>", "array<double>", "array<double>"), ("map<string,int>", "map<string,string>", "map<string,string>"), ("struct<a:int>", "string", "string"),
        ("struct<a:int,b:struct<c:int>>", "struct<b:struct<c:bigint,d:date>,e:int>", "struct<a:int,b:struct<c:bigint,d:date>,e:int>"), ("array<struct<a:int>>", "int", "string"),
    ],
)
def test_types_merge_to_the_least_that_holds_both(spark, a, b, want):
    assert lattice.merged_type(typed(a), typed(b)).simpleString() == want
    if not want.startswith("struct"):  # the order of fields is that of the first
        assert lattice.merged_type(typed(b), typed(a)).simpleString() == want


def test_old_rows_are_read_by_the_new_type(spark):
    old = spark.sql("SELECT 1 AS id, array(named_struct('q', 2)) AS items, named_struct('x', 1) AS s, map('k', 1) AS m UNION ALL SELECT NULL, NULL, NULL, NULL")
    new = spark.sql("SELECT 'a' AS id, array(named_struct('q', 2.5D, 'n', 'z')) AS items, 'plain' AS s, map('k', 1.5D) AS m, date'2024-01-01' AS d")
    rows = [r.asDict(recursive=True) for r in lattice.merge_generations([old, new]).collect()]
    assert rows[0] == {"id": "1", "items": [{"q": 2.0, "n": None}], "s": '{"x":1}', "m": {"k": 1.0}, "d": None}
    assert rows[1] == dict.fromkeys(rows[0])
    assert rows[2] == {"id": "a", "items": [{"q": 2.5, "n": "z"}], "s": "plain", "m": {"k": 1.5}, "d": dt.date(2024, 1, 1)}
    found = lattice.changes(old.schema, new.schema)
    assert ("items[].q", "widened", "int", "double") in found and ("items[].n", "added", None, "string") in found and ("d", "added", None, "date") in found and ("s", "widened", "struct<x:int>", "string") in found
