"""Registration of queries and of the SQL they are compared with."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from weirflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# "Now" of the two families of messages: the event messages are of 2024, the others of 1995 to 2001.
AS_OF = dt.datetime(2024, 2, 1)
AS_OF_2001 = dt.datetime(2001, 8, 2)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; without ``sql`` only its rows are checked."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
