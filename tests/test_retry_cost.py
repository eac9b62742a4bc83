"""A round of retries sorts no ledger for its last attempts, and gathers no letters in one task."""

import glob

from weirflow.operators.retries import _LEDGER, ACCEPTED, FAILING, GIVEN_UP, ROUND, last_attempts
from weirflow.operators.sinks import write_partitions


def test_last_attempts_are_hashed(spark):
    rows = [("t", 0, 7, 1, FAILING, 5, 1), ("t", 0, 7, 2, ACCEPTED, None, 2), ("t", 1, 7, 1, FAILING, 9, 1), ("u", 1, 7, 3, GIVEN_UP, None, 3), ("u", 1, 7, 2, FAILING, 4, 2)]
    last = last_attempts(spark.createDataFrame(rows, _LEDGER))
    assert last.columns == ["original_topic", "original_partition", "original_offset", "attempt", "outcome", "due_ms"]
    assert sorted(map(tuple, last.collect())) == [("t", 0, 7, 2, ACCEPTED, None), ("t", 1, 7, 1, FAILING, 9), ("u", 1, 7, 3, GIVEN_UP, None)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_rows_of_one_partition_are_written_by_the_tasks_that_have_them(spark, tmp_path):
    rows = spark.createDataFrame([("t", 0, k, 1, FAILING, 5, 4) for k in range(60)], _LEDGER).repartition(3)
    for _ in range(2):  # a second time it replaces the first
        write_partitions(rows, str(tmp_path), (ROUND,), gather=False)
        assert len(glob.glob(f"{tmp_path}/{ROUND}=4/*.parquet")) == 3 and spark.read.parquet(str(tmp_path)).count() == 60
