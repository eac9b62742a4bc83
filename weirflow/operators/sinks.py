"""Sinks: partitioned tables, JSON Lines, statistics of written files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "ingest_batch"


def write_batch(df: DataFrame, path: str, partition_columns: tuple[str, ...], batch_id: int, file_format: str = "parquet") -> None:
    """Write one batch below ``ingest_batch=<id>``.

    Only the partitions of this batch are overwritten, so writing a batch again replaces what the
    first attempt left behind, whole or partial.  Rows are brought together by partition first, by a
    rebalance: it keeps small partitions in one file and splits large ones over several tasks.
    """
    write_partitions(df.withColumn(BATCH, F.lit(batch_id).cast("bigint")), path, (BATCH, *partition_columns), file_format)


def write_partitions(df: DataFrame, path: str, columns: tuple[str, ...], file_format: str = "parquet", gather: bool = True) -> None:
    """Write below ``<column>=<value>/`` directories; those of ``df`` replace what they held, others stay.

    Rows are brought together by partition first, unless ``gather`` is false: then each task writes what it has.
    """
    gathered = df.hint("rebalance", *[c for c in columns if c != BATCH]) if gather else df
    (
        gathered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .format(file_format)
        .save(path)
    )


def append_table(df: DataFrame, path: str, partition_columns: tuple[str, ...], file_format: str = "parquet") -> None:
    clustered = df.hint("rebalance", *partition_columns)
    clustered.write.mode("append").partitionBy(*partition_columns).format(file_format).save(path)


def read_table(spark: SparkSession, path: str, file_format: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """The latest state of a table; ``merge_schema`` finds columns added by later batches."""
    return spark.read.format(file_format).option("mergeSchema", str(merge_schema).lower()).load(path)


def write_jsonl(df: DataFrame, path: str, partition_columns: tuple[str, ...], text: str = "record") -> None:
    """JSON Lines files of ready-made text below ``<column>=<value>/`` directories, packed by gzip; readers of
    JSON unpack them by their name."""
    lines = df.select(*partition_columns, F.col(text).alias("value")).hint("rebalance", *partition_columns)
    lines.write.mode("append").option("compression", "gzip").partitionBy(*partition_columns).text(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and time of every data file of a directory tree; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.lit(path).alias("table_path"),
            F.regexp_extract("path", r"^(.*)/[^/]*\z", 1).alias("partition"),
            "path",
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def writer_stats(table: DataFrame, keys: list[str]) -> DataFrame:
    """Records, files, bytes and last write per partition of a file-based table."""
    per_file = (
        table.select(*keys, "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        .groupBy(*keys, "file_path")
        .agg(
            F.count("*").alias("_records"),
            F.first("file_size").alias("_size"),
            F.first("file_modification_time").alias("_written"),
        )
    )
    return per_file.groupBy(*keys).agg(
        F.sum("_records").alias("records"),
        F.count("*").alias("files"),
        F.sum("_size").alias("bytes"),
        F.max("_written").alias("last_write"),
    )
