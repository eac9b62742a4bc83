"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  Every query is run once to warm up the
JVM (the flow twice) and then timed; results go to Spark's no-op sink, so all rows and columns are computed and nothing
is collected.  ``ingest`` is the whole flow with both writes, and its rate is messages per second.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weirflow.config import COMMERCE_EVENTS  # noqa: E402
from weirflow.plans.flow import write_messages  # noqa: E402
from weirflow.plans.queries import QUERIES  # noqa: E402
from weirflow.plans.queries.registry import AS_OF_2001  # noqa: E402
from weirflow.session import local_session, scratch_path  # noqa: E402
from weirflow.sources import envelopes as src  # noqa: E402

HEADLINE = (
    "accepted_by_event_type", "table_rows", "validation_summary", "jsonschema_order", "parse_nested_items", "dlq_envelope", "message_transform",
    "fingerprint_dedup", "dedup_offset", "batch_assignment", "duplicate_report", "infer_schema", "topic_metrics", "latency_percentiles",
    "failure_streaks", "breaker_replay", "compaction_plan", "events_by_type_daily",
)


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run = lambda name=name: _noop(QUERIES[name](spark, sf_dir))
        run()
        seconds[name] = _timed(run)

    # Messages as they lie in the landing folder; making them is not part of ingesting them.
    landing = scratch_path(spark, "landing")
    src.commerce_envelopes(spark, sf_dir).write.parquet(landing)
    messages = src.file_batch(spark, landing)
    total = messages.count()
    topics = (COMMERCE_EVENTS,)
    ingest = lambda n: write_messages(messages, scratch_path(spark, f"lake{n}"), n, topics, AS_OF_2001)
    ingest(0)
    ingest(1)
    seconds["ingest"] = min(_timed(lambda: ingest(n)) for n in (2, 3))
    rate = round(total / seconds["ingest"])

    # The default path: messages of three topics, and the clock taken from the batch itself.
    mixed = scratch_path(spark, "mixed")
    makers = (src.user_event_envelopes, src.commerce_envelopes, src.order_envelopes)
    for make in makers:
        make(spark, sf_dir).write.mode("append").parquet(mixed)
    everything = src.file_batch(spark, mixed)
    mixed_total = everything.count()
    default = lambda n: write_messages(everything, scratch_path(spark, f"lake{n}"), n)
    default(0)
    seconds["ingest_default"] = _timed(lambda: default(1))
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "ingest_messages": total, "ingest_messages_per_second": rate, "cpus": cpus,
                "default_messages": mixed_total, "default_messages_per_second": round(mixed_total / seconds["ingest_default"]),
            }
        )
    )


if __name__ == "__main__":
    main()
