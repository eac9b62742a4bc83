"""Circuit breakers replayed over a table of call outcomes, and streaks of failures.

The state after a call depends on all earlier calls of the service, and one service may hold a large
share of the calls.  So the calls are cut into chunks in (service, time) order; each chunk is
summarised in parallel as a map from any state before it to the state after it; the few summaries of
a service are folded in order to get the state before each chunk; and the chunks are replayed in
parallel from there.
"""

from __future__ import annotations

import sys
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.functions import breaker as b
from weirflow.functions.ordered import CHUNK, range_chunks, running_sum

# The helpers travel with the tasks, so executors need no copy of this package.
for _module in (b, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

ORDER = ["service", "at_ms", "call_id"]
CALLS_PER_CHUNK = 50_000  # a chunk is one frame of a Python worker, with lists and states beside it

_SUMMARY = (
    f"service string, {CHUNK} int, kinds array<int>, amounts array<bigint>, "
    "limits array<bigint>, open_kinds array<int>, open_amounts array<bigint>"
)
_STATE = "service string, kind int, amount bigint"
_STARTS = f"service string, {CHUNK} int, kind int, amount bigint"
_REPLAY = "service string, call_id bigint, at_ms bigint, failed boolean, allowed boolean, state string"


def _sorted_calls(pdf: pd.DataFrame):
    pdf = pdf.sort_values(["at_ms", "call_id"])
    return pdf, pdf["at_ms"].tolist(), pdf["failed"].tolist(), pdf["trips"].tolist()


def _summariser(s: b.BreakerSettings):
    def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        _, at, failed, trips = _sorted_calls(pdf)
        ends, waking = b.summarise(at, failed, trips, s)
        row = (
            key[0], key[1], [k for k, _ in ends], [v for _, v in ends],
            [limit for limit, _ in waking], [e[0] for _, e in waking], [e[1] for _, e in waking],
        )
        return pd.DataFrame([row], columns=["service", CHUNK, "kinds", "amounts", "limits", "open_kinds", "open_amounts"])

    return run


def _folder(s: b.BreakerSettings):
    def run(key: tuple[Any, ...], pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        state, rows = (int(known["kind"].iloc[0]), int(known["amount"].iloc[0])) if len(known) else b.START, []
        for r in pdf.sort_values(CHUNK).itertuples(index=False):
            rows.append((key[0], getattr(r, CHUNK), *state))
            ends = [(int(k), int(v)) for k, v in zip(r.kinds, r.amounts)]
            waking = [(int(m), (int(k), int(v))) for m, k, v in zip(r.limits, r.open_kinds, r.open_amounts)]
            state = b.apply_summary(state, ends, waking, s)
        rows.append((key[0], -1, *state))  # after all calls
        return pd.DataFrame(rows, columns=["service", CHUNK, "kind", "amount"])

    return run


def _replayer(s: b.BreakerSettings):
    def run(key: tuple[Any, ...], calls: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        pdf, at, failed, trips = _sorted_calls(calls)
        state = (int(start["kind"].iloc[0]), int(start["amount"].iloc[0]))
        allowed, names = [], []
        for t, bad, opens in zip(at, failed, trips):
            state, let = b.step(state, t, bad, opens, s)
            allowed.append(let)
            names.append(b.NAMES[state[0]])
        return pd.DataFrame(
            {"service": key[0], "call_id": pdf["call_id"], "at_ms": pdf["at_ms"], "failed": pdf["failed"], "allowed": allowed, "state": names}
        )

    return run


def breaker_replay(calls: DataFrame, settings: b.BreakerSettings = b.SERVICE_BREAKER, chunks: int | None = None, before: DataFrame | None = None) -> DataFrame:
    """(service, call_id, at_ms, failed[, trips]) -> the same calls with ``allowed`` and ``state`` after.

    Calls with ``allowed`` false met an open breaker; they are kept, for the dead-letter table.
    ``before`` is where the services stood before the calls (see :func:`breaker_ends`); by default closed.
    """
    by_chunk, starts = _started(calls, settings, chunks, before)
    return by_chunk.cogroup(starts.filter(F.col(CHUNK) >= 0).groupBy("service", CHUNK)).applyInPandas(_replayer(settings), _REPLAY)


def _started(calls: DataFrame, settings: b.BreakerSettings, chunks: int | None, before: DataFrame | None):
    trips = F.col("trips") if "trips" in calls.columns else F.lit(True)
    placed = range_chunks(calls.select("service", "call_id", "at_ms", "failed", trips.alias("trips")), ORDER, chunks, CALLS_PER_CHUNK)
    by_chunk = placed.groupBy("service", CHUNK)
    summaries = by_chunk.applyInPandas(_summariser(settings), _SUMMARY)
    known = before if before is not None else calls.sparkSession.createDataFrame([], _STATE)
    starts = summaries.groupBy("service").cogroup(known.select("service", "kind", "amount").groupBy("service")).applyInPandas(_folder(settings), _STARTS)
    return by_chunk, starts


def breaker_ends(calls: DataFrame, settings: b.BreakerSettings = b.SERVICE_BREAKER, chunks: int | None = None, before: DataFrame | None = None) -> DataFrame:
    """(service, kind, amount): where each service stands after the calls, for the next batch; services
    without a call stay where they were."""
    _, starts = _started(calls, settings, chunks, before)
    return starts.filter(F.col(CHUNK) < 0).select("service", "kind", "amount")


def failure_streaks(calls: DataFrame, min_length: int = 5, chunks: int | None = None) -> DataFrame:
    """Runs of at least ``min_length`` failures without a success in between, per service.

    Failures with the same number of earlier successes form one run, so a running count of successes
    and one aggregation are enough.
    """
    placed = range_chunks(calls.select("service", "call_id", "at_ms", "failed"), ORDER, chunks)
    counted = running_sum(placed, ["service"], ["at_ms", "call_id"], (~F.col("failed")).cast("bigint"), "_successes")
    return (
        counted.filter("failed")
        .groupBy("service", "_successes")
        .agg(F.count("*").alias("failures"), F.min("at_ms").alias("first_ms"), F.max("at_ms").alias("last_ms"))
        .filter(F.col("failures") >= min_length)
        .select("service", "failures", "first_ms", "last_ms")
    )


def trips_topic_breaker(error_class: str = "error_class", error_message: str = "error_message"):
    """Failures that may open a topic's breaker: schema, authentication and validation errors."""
    message = F.lower(F.coalesce(error_message, F.lit("")))
    kind = F.lower(F.coalesce(error_class, F.lit("")))
    return message.rlike("schema|unauthorized|authentication") | kind.rlike("security|validation") | (kind == "nonretriableexception")


def with_trips(calls: DataFrame, errors: DataFrame) -> DataFrame:
    """Calls with ``trips`` from the log of errors (call_id, error_class, error_message); a failure without
    an entry trips nothing."""
    marks = errors.select("call_id", trips_topic_breaker().alias("trips"))
    return calls.join(marks, "call_id", "left").withColumn("trips", F.coalesce("trips", F.lit(False)))


def blocked(replayed: DataFrame) -> DataFrame:
    """Calls that met an open breaker; route them to the dead-letter table instead of dropping them."""
    return replayed.filter(~F.col("allowed"))


def blocked_messages(messages: DataFrame, replayed: DataFrame) -> DataFrame:
    """Messages (with ``call_id``) whose call met an open breaker, as rejects for the dead letters."""
    met = messages.join(blocked(replayed).select("call_id"), "call_id", "left_semi")
    return met.withColumns({"reject_rule": F.lit("breaker_open"), "reject_reason": F.concat(F.lit("The breaker of "), "topic", F.lit(" is open"))})
