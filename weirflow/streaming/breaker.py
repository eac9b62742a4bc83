"""The circuit breaker on a stream of call outcomes, one state per service."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirflow.functions import breaker as b

for _module in (b, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

OUTPUT = "service string, call_id bigint, at_ms bigint, failed boolean, allowed boolean, state string"
ROWS_AT_ONCE = 50_000  # rows given back at a time


class BreakerProcessor(StatefulProcessor):
    """Applies the calls of a batch in time order and keeps (kind, value) between batches.

    Of a service's calls a task holds three numbers each, which it must to sort them; what it gives back
    it makes in parts.
    """

    def __init__(self, settings: b.BreakerSettings):
        self.settings = settings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("breaker", "kind int, amount bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.state.update((int(initialState["kind"].iloc[0]), int(initialState["amount"].iloc[0])))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = tuple(int(v) for v in self.state.get()) if self.state.exists() else b.START
        parts = [(p["at_ms"].to_numpy(np.int64), p["call_id"].to_numpy(np.int64), p["failed"].to_numpy(bool) + 2 * p["trips"].to_numpy(bool).astype(np.int8)) for p in rows]
        at_ms, call_id, marks = (np.concatenate(c) for c in zip(*parts))
        del parts
        order = np.lexsort((call_id, at_ms))
        for first in range(0, len(order), ROWS_AT_ONCE):
            part = order[first : first + ROWS_AT_ONCE]
            allowed, names = [], []
            for at, mark in zip(at_ms[part].tolist(), marks[part].tolist()):
                state, let = b.step(state, at, bool(mark & 1), bool(mark & 2), self.settings)
                allowed.append(let)
                names.append(b.NAMES[state[0]])
            yield pd.DataFrame({"service": key[0], "call_id": call_id[part], "at_ms": at_ms[part], "failed": (marks[part] & 1).astype(bool), "allowed": allowed, "state": names})
        self.state.update((int(state[0]), int(state[1])))

    def close(self) -> None:
        pass


def breaker_stream(calls: DataFrame, settings: b.BreakerSettings = b.SERVICE_BREAKER, before: DataFrame | None = None) -> DataFrame:
    """(service, call_id, at_ms, failed[, trips]) stream -> the calls with ``allowed`` and ``state``.

    ``before`` (service, kind, amount) is where services stand when the stream starts for the first time,
    such as :func:`weirflow.operators.breaker.breaker_ends` of a batch replay gives.
    """
    trips = F.col("trips") if "trips" in calls.columns else F.lit(True)
    return calls.select("service", "call_id", "at_ms", "failed", trips.alias("trips")).groupBy("service").transformWithStateInPandas(
        statefulProcessor=BreakerProcessor(settings), outputStructType=OUTPUT, outputMode="Append", timeMode="None",
        initialState=None if before is None else before.select("service", "kind", "amount").groupBy("service"),
    )
