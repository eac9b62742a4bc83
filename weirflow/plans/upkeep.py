"""Maintenance jobs: rewriting the small files of a table, and recording which operation ran when.

Nothing here switches readers or deletes files: which files make up a table is for the table format or
the catalog to say.  The decisions (what is due, which files to merge, which to drop) are in
:mod:`weirflow.operators.maintenance`.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weirflow.config import Destination
from weirflow.operators.maintenance import OPTIMIZE, TARGET_BYTES, VACUUM, compaction_plan, maintenance_stats
from weirflow.operators.sinks import BATCH, file_inventory, read_table

log = logging.getLogger(__name__)


def read_as_text(spark: SparkSession, path: str, partition_columns: tuple[str, ...]) -> DataFrame:
    """A table with its partition columns as the directories spell them (``month=01`` stays ``01``)."""
    found = read_table(spark, path).schema
    for column in (BATCH, *partition_columns):
        if column in found.names:
            found[column].dataType = StringType()
    return spark.read.schema(found).parquet(path)


def compact(
    spark: SparkSession, table: str, output: str, partition_columns: tuple[str, ...], before_batch: int | None = None, target_bytes: int = TARGET_BYTES, files: DataFrame | None = None
) -> DataFrame:
    """Rewrite the closed batches of a table that :func:`write_messages` fills into ``output``.

    Closed are the batches below ``before_batch`` (default: all).  Small files of one table partition
    are merged across batches, in bins of about ``target_bytes``; rows of larger files stay with the
    splits of their file.  The number of the batch stays with each row as the column ``ingest_batch``,
    and partition values stay as they were.  ``files`` is what a ledger knows of the table's files; by
    default they are listed.  Returns the table that was written.
    """
    rows = read_as_text(spark, table, partition_columns)
    closed = F.lit(True) if before_batch is None else F.col(BATCH).cast("bigint") < before_batch
    listed = files if files is not None else file_inventory(spark, table)
    files = listed.filter(F.col("path").contains(f"/{BATCH}=") & F.col("path").endswith(".parquet"))
    # Files of different batches lie in one bin if the rest of their directories agrees.
    place = F.regexp_replace("partition", rf"^.*/{BATCH}=[^/]*", "")
    bins = compaction_plan(files.withColumn("partition", place), target_bytes).select(
        F.col("path").alias("_path"), F.concat_ws("/", "partition", "bin_no").alias("_bin")
    )
    tagged = rows.filter(closed).withColumn("_path", F.col("_metadata.file_path"))
    small = tagged.join(bins, "_path").repartition("_bin").drop("_path", "_bin")
    large = tagged.join(bins, "_path", "left_anti").drop("_path")
    merged = small.unionByName(large).withColumn(BATCH, F.col(BATCH).cast("bigint"))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_columns).parquet(output)
    return spark.read.schema(merged.schema).parquet(output)


def record_commit(spark: SparkSession, commit_log: str, table: str, operation: str, at: dt.datetime) -> None:
    """Append a row to the commit log that the due checks read."""
    row = spark.createDataFrame([(table, at, operation)], "table_path string, committed_at timestamp, operation string")
    row.withColumn(BATCH, F.lit(-1).cast("bigint")).coalesce(1).write.mode("append").partitionBy(BATCH).parquet(commit_log)


def maintain(
    spark: SparkSession, table: str, output: str, destination: Destination, commit_log: str, as_of: dt.datetime, log_name: str | None = None, files: DataFrame | None = None
) -> dict[str, bool]:
    """Compact a table if due, and say whether its storage should drop old files.

    ``log_name`` is the table's name in the commit log (default: its path), ``files`` what a ledger knows
    of its files.

    Returns the operations that were due with whether they are done.  A failure is logged, does not
    stop the caller and is not recorded, so it is tried again.  VACUUM is never done here: it is the
    storage's own, and recorded by whoever runs it.
    """
    options = destination.options
    name = log_name or table
    mine = spark.read.parquet(commit_log).filter(F.col("table_path") == name)
    stats = maintenance_stats(mine).first()
    done: dict[str, bool] = {}
    if stats is None:
        return done
    if options.enable_optimize and stats["batches_since_optimize"] >= options.optimize_interval:
        try:
            compact(spark, table, output, destination.partition_columns, files=files)
            record_commit(spark, commit_log, name, OPTIMIZE, as_of)
            done[OPTIMIZE] = True
        except Exception:  # noqa: BLE001
            log.warning("%s of %s failed", OPTIMIZE, table, exc_info=True)
            done[OPTIMIZE] = False
    last = stats["last_vacuum"]
    if options.enable_vacuum and (last is None or as_of - last >= dt.timedelta(hours=options.vacuum_retention_hours)):
        done[VACUUM] = False
    return done
