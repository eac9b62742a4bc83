"""Table maintenance: what is due, which files to merge or drop, and doing it.

Inputs are three tables: ``commits`` (table_path, committed_at, operation), ``files`` (table_path,
partition, path, size, modified_at) and the topic settings.  Deciding is separate from doing, so the
decisions can be checked and run as a scheduled job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.ordered import ROWS_PER_CHUNK, range_chunks, running_sum
from weirflow.functions.times import as_of_timestamp

WRITE, OPTIMIZE, VACUUM = "WRITE", "OPTIMIZE", "VACUUM"
TARGET_BYTES = 128 * 1024 * 1024


def _last(operation: str) -> Column:
    return F.max(F.when(F.col("operation") == operation, F.col("committed_at")))


def last_runs(commits: DataFrame) -> DataFrame:
    return commits.groupBy("table_path").agg(_last(OPTIMIZE).alias("last_optimize"), _last(VACUUM).alias("last_vacuum"))


def maintenance_stats(commits: DataFrame) -> DataFrame:
    """Writes since the last compaction and the times of the last runs, per table."""
    runs = last_runs(commits)
    writes = commits.filter(F.col("operation") == WRITE).select("table_path", "committed_at")
    since = (
        writes.join(runs, "table_path")
        .groupBy("table_path")
        .agg(F.count_if(F.col("last_optimize").isNull() | (F.col("committed_at") > F.col("last_optimize"))).alias("batches_since_optimize"))
    )
    return runs.join(since, "table_path", "left").select(
        "table_path", F.coalesce("batches_since_optimize", F.lit(0)).alias("batches_since_optimize"), "last_optimize", "last_vacuum"
    )


def optimize_due(stats: DataFrame, settings: DataFrame) -> DataFrame:
    """Enabled tables with at least ``optimize_interval`` writes since the last compaction."""
    return stats.join(settings, "table_path").withColumn(
        "due", F.col("enable_optimize") & (F.col("batches_since_optimize") >= F.col("optimize_interval"))
    ).select("table_path", "batches_since_optimize", "optimize_interval", "due")


def vacuum_due(stats: DataFrame, settings: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Enabled tables never vacuumed, or not within their retention time."""
    age_ms = F.unix_millis(as_of_timestamp(as_of)) - F.unix_millis("last_vacuum")
    due = F.col("last_vacuum").isNull() | (age_ms >= F.col("vacuum_retention_hours").cast("bigint") * 3_600_000)
    return stats.join(settings, "table_path").select(
        "table_path", "last_vacuum", "vacuum_retention_hours", (F.col("enable_vacuum") & due).alias("due")
    )


def vacuum_candidates(files: DataFrame, live: DataFrame, as_of: dt.datetime, retention_hours: int = 168) -> DataFrame:
    """Files that no snapshot refers to and that are older than the retention time."""
    cutoff = as_of_timestamp(as_of - dt.timedelta(hours=retention_hours))
    return files.filter(F.col("modified_at") < cutoff).join(live.select("path"), "path", "left_anti")


def compaction_plan(files: DataFrame, target_bytes: int = TARGET_BYTES, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Assign the small files of each table partition to bins of about ``target_bytes``.

    Bins are cut along the running size in path order.  The running size is taken over chunks of the
    file list, so a partition of any number of files gets the same bins and no task holds them all.
    """
    place = ["table_path", "partition"]
    small = files.filter(F.col("size") < target_bytes).select(*place, "path", "size")
    order = [*place, "path"]
    summed = running_sum(range_chunks(small, order, rows_per_chunk=rows_per_chunk), place, order, F.col("size"), "_upto")
    bin_no = F.floor((F.col("_upto") - F.col("size")) / F.lit(target_bytes)).cast("bigint")
    return summed.select(*order, "size", bin_no.alias("bin_no"))


def bins_to_merge(plan: DataFrame) -> DataFrame:
    """Bins with more than one file: merging the others would gain nothing."""
    return (
        plan.groupBy("table_path", "partition", "bin_no")
        .agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
        .filter(F.col("files") > 1)
    )
