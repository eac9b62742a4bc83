"""Ledgers of an ingestion: what each run did to each topic, and which files it wrote.

Both are tables below the root that runs write as they go, so nobody has to list a lake's files or read
its logs.  Rows are keyed by batch, so a batch that runs again replaces what it said before; a run that
failed keeps a row of its own beside that of the run that succeeded later.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.config import DESTINATION, TopicConfig
from weirflow.functions.times import as_of_timestamp
from weirflow.operators.maintenance import WRITE
from weirflow.operators.sinks import BATCH, read_table, write_batch, write_partitions
from weirflow.plans.upkeep import maintain

log = logging.getLogger(__name__)

RUNS_PATH, FILES_PATH, COMMITS_PATH = "runs", "files", "commits"
_RUN = "batch_id bigint, topic string, success boolean, processed bigint, failed bigint, started_at timestamp, ended_at timestamp, duration_ms bigint, error_message string"
_FILE = "table_path string, partition string, path string, size bigint, rows bigint, modified_at timestamp"


def _at(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


# ---- runs -----------------------------------------------------------------------------------


def record_run(spark: SparkSession, root: str, batch_id: int, counts: list[tuple[str, int, int]], began: dt.datetime, ended: dt.datetime, error: str | None = None) -> None:
    """One row for each topic of a run; ``counts`` is (topic, processed, failed).  A run that failed has one row
    without a topic, with the message of its error."""
    ms = int((ended - began).total_seconds() * 1000)
    rows = [(batch_id, t, True, n, bad, began, ended, ms, None) for t, n, bad in counts]
    if error is not None:
        rows = [(batch_id, None, False, 0, 0, began, ended, ms, error)]
    if rows:
        run = spark.createDataFrame(rows, _RUN).withColumn(BATCH, F.lit(batch_id).cast("bigint")).coalesce(1)
        write_partitions(run.withColumn("outcome", F.when(F.col("success"), "done").otherwise("failed")), _at(root, RUNS_PATH), (BATCH, "outcome"))


def run_results(spark: SparkSession, root: str) -> DataFrame:
    """All runs of an ingestion: batch, topic, success, processed, failed, start, end, milliseconds, error."""
    return read_table(spark, _at(root, RUNS_PATH)).select("batch_id", "topic", "success", "processed", "failed", "started_at", "ended_at", "duration_ms", "error_message")


# ---- files ----------------------------------------------------------------------------------


def written_files(spark: SparkSession, root: str, batch_id: int) -> DataFrame | None:
    """The files of one batch with their sizes and rows, from the directories of that batch only; the
    rows come from the files' footers.  None if the batch wrote no table."""
    try:
        found = spark.read.schema("_unread int").option("recursiveFileLookup", "true").parquet(_at(root, f"{DESTINATION}=*/{BATCH}={batch_id}"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    path, place = F.col("path"), rf"^(.*/{DESTINATION}=[^/]*)/"
    per_file = found.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").groupBy(F.col("file_path").alias("path"))
    counted = per_file.agg(F.first("file_size").alias("size"), F.count("*").alias("rows"), F.first("file_modification_time").alias("modified_at"))
    return counted.select(F.regexp_extract(path, place, 1).alias("table_path"), F.regexp_extract(path, r"^(.*)/[^/]*\z", 1).alias("partition"), "path", "size", "rows", "modified_at")


def record_files(spark: SparkSession, root: str, batch_id: int, at: dt.datetime) -> list[str]:
    """Add the files of a batch to the ledger and a commit for each table that it wrote; returns the tables' names."""
    files = written_files(spark, root, batch_id)
    if files is None:
        return []
    write_batch(files, _at(root, FILES_PATH), (), batch_id)
    mine = spark.read.schema(_FILE).parquet(_at(root, f"{FILES_PATH}/{BATCH}={batch_id}")).select("table_path").distinct()
    commits = mine.select(F.regexp_extract("table_path", rf"/{DESTINATION}=([^/]*)\z", 1).alias("table_path"), as_of_timestamp(at).alias("committed_at"), F.lit(WRITE).alias("operation"))
    write_batch(commits, _at(root, COMMITS_PATH), (), batch_id)
    named = spark.read.schema("table_path string").parquet(_at(root, f"{COMMITS_PATH}/{BATCH}={batch_id}"))
    return sorted(r.table_path for r in named.collect())  # one a table


def inventory(spark: SparkSession, root: str, destination: str | None = None) -> DataFrame:
    """All files that runs have recorded, of one table or of all, in the columns of
    :func:`weirflow.operators.sinks.file_inventory` and with their rows; no directory is listed but the ledger's."""
    files = read_table(spark, _at(root, FILES_PATH)).select("table_path", "partition", "path", "size", "rows", "modified_at")
    return files if destination is None else files.filter(F.col("table_path").endswith(f"/{DESTINATION}={destination}"))


# ---- after a flush --------------------------------------------------------------------------


def after_flush(spark: SparkSession, root: str, batch_id: int, topics: tuple[TopicConfig, ...], at: dt.datetime) -> dict[str, dict[str, bool]]:
    """Record the files of a batch and run what maintenance is due for the tables that it wrote.

    Compacted tables go to ``compacted/<table>`` below the root.  A failure of maintenance is logged
    and does not stop the ingestion.
    """
    done = {}
    places = {t.destination.table_name: t.destination for t in topics}
    for name in record_files(spark, root, batch_id, at):
        if name not in places:
            continue
        try:
            place = places[name]
            done[name] = maintain(spark, place.location(root), _at(root, f"compacted/{name}"), place, _at(root, COMMITS_PATH), at, log_name=name, files=inventory(spark, root, name))
        except Exception:  # noqa: BLE001
            log.warning("maintenance of %s failed", name, exc_info=True)
    return done
