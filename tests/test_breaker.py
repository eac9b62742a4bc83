import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from weirflow.functions import breaker as b
from weirflow.operators import breaker as op
from weirflow.streaming.breaker import breaker_stream

MINUTE = 60_000


def run(calls, s=b.SERVICE_BREAKER):
    state, out = b.START, []
    for at, failed in calls:
        state, let = b.step(state, at, failed, True, s)
        out.append((b.NAMES[state[0]], let))
    return out


def test_life_of_a_breaker():
    fails = [(i, True) for i in range(5)]
    assert [s for s, _ in run(fails)] == ["CLOSED"] * 4 + ["OPEN"]
    assert run(fails + [(4 + MINUTE, False)])[-1] == ("OPEN", False)
    assert run(fails + [(5 + MINUTE, False)])[-1] == ("HALF_OPEN", True)
    assert run(fails + [(5 + MINUTE, True)])[-1] == ("OPEN", True)
    assert run(fails + [(5 + MINUTE + i, False) for i in range(3)])[-1] == ("CLOSED", True)
    assert run(fails[:4] + [(9, False), (10, True)])[-1] == ("CLOSED", True)


def test_only_tripping_failures_open():
    state = b.START
    for i in range(7):
        state, _ = b.step(state, i, True, False, b.TOPIC_BREAKER)
    assert state == (b.CLOSED, 5)
    assert b.step(state, 8, True, True, b.TOPIC_BREAKER)[0] == (b.OPEN, 8)


calls_strategy = st.lists(st.tuples(st.integers(0, 40), st.booleans(), st.booleans()), min_size=1, max_size=60)


@settings(max_examples=300, deadline=None)
@given(calls_strategy, st.integers(0, 60), st.sampled_from([b.BreakerSettings(2, 5, 2), b.BreakerSettings(5, 60, 3), b.BreakerSettings(1, 0, 1)]))
def test_summaries_equal_stepping(raw, cut, s):
    """Cutting anywhere and applying the summary gives the state that stepping gives."""
    at, t = [], 0
    for gap, _, _ in raw:
        t += gap
        at.append(t)
    failed, trips = [f for _, f, _ in raw], [p for _, _, p in raw]
    cut = min(cut, len(at) - 1)
    state = b.START
    for i in range(cut):
        state, _ = b.step(state, at[i], failed[i], trips[i], s)
    jumped = b.apply_summary(state, *b.summarise(at[cut:], failed[cut:], trips[cut:], s), s)
    for i in range(cut, len(at)):
        state, _ = b.step(state, at[i], failed[i], trips[i], s)
    assert jumped == state


def outcomes(n=400, seed=3):
    rng, rows, t = random.Random(seed), [], 0
    for i in range(n):
        t += rng.choice([0, 1, 500, 20_000, 70_000])
        service = "hot" if rng.random() < 0.6 else f"s{rng.randrange(4)}"
        rows.append((service, i, t, rng.random() < 0.7))
    return rows


SCHEMA = "service string, call_id long, at_ms long, failed boolean"


@pytest.mark.parametrize("chunks", [1, 3, 16])
def test_replay_is_the_same_for_any_chunks(spark, chunks):
    rows = outcomes()
    got = {(r.service, r.call_id): (r.state, r.allowed) for r in op.breaker_replay(spark.createDataFrame(rows, SCHEMA), chunks=chunks).collect()}
    want = {}
    for service in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == service]
        for r, result in zip(mine, run([(x[2], x[3]) for x in mine])):
            want[(service, r[1])] = result
    assert got == want and any(not let for _, let in got.values())


@pytest.mark.parametrize("chunks", [1, 7])
def test_streaks(spark, chunks):
    rows = outcomes()
    got = sorted((r.service, r.failures, r.first_ms) for r in op.failure_streaks(spark.createDataFrame(rows, SCHEMA), 3, chunks).collect())
    want = []
    for service in {r[0] for r in rows}:
        streak = []
        for r in [x for x in rows if x[0] == service] + [(service, -1, 0, False)]:
            if r[3]:
                streak.append(r)
            else:
                if len(streak) >= 3:
                    want.append((service, len(streak), streak[0][2]))
                streak = []
    assert got == sorted(want)


def test_stream_equals_batch(spark, tmp_path):
    rows = outcomes(200)
    for i, part in enumerate((rows[:90], rows[90:])):
        pd.DataFrame(part, columns=["service", "call_id", "at_ms", "failed"]).to_parquet(tmp_path / f"{i}.parquet")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path))
    query = breaker_stream(stream).writeStream.format("memory").queryName("breaker_out").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.call_id, r.state, r.allowed) for r in spark.table("breaker_out").collect()}
    want = {(r.call_id, r.state, r.allowed) for r in op.breaker_replay(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_a_stream_goes_on_where_a_batch_replay_ended(spark, tmp_path):
    rows = sorted(outcomes(200), key=lambda r: r[2])
    rows = [(*r, k % 3 != 0) for k, r in enumerate(rows)]
    schema = f"{SCHEMA}, trips boolean"
    settings = b.BreakerSettings(failure_threshold=3, open_ms=30_000, success_threshold=2)
    whole = spark.createDataFrame(rows, schema)
    half = rows[100][2]
    early = whole.filter(f"at_ms < {half}")
    for i, part in enumerate(([r for r in rows if half <= r[2] < rows[150][2]], [r for r in rows if r[2] >= rows[150][2]])):
        pd.DataFrame(part, columns=["service", "call_id", "at_ms", "failed", "trips"]).to_parquet(tmp_path / f"{i}.parquet")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path))
    before = spark.createDataFrame(op.breaker_ends(early, settings).collect(), "service string, kind int, amount bigint")
    out = breaker_stream(stream, settings, before).writeStream.format("memory").queryName("breaker_on").option("checkpointLocation", str(tmp_path / "cp"))
    out.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = {(r.call_id, r.state, r.allowed) for r in spark.table("breaker_on").collect()}
    want = {(r.call_id, r.state, r.allowed) for r in op.breaker_replay(whole, settings).filter(f"at_ms >= {half}").collect()}
    assert got == want and len(got) >= 99
