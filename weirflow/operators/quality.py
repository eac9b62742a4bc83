"""Checks on written tables: required columns, metadata, path and file layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.enrich import RECORD_VERSION

# The columns each table must have, and the path patterns.
USER_TABLE_COLUMNS = (
    "user_id", "event_type", "timestamp", "properties", "_kafka_topic", "_kafka_partition", "_kafka_offset",
    "_processed_at", "_ingestion_timestamp", "year", "month", "day",
)
ORDER_TABLE_COLUMNS = (
    "order_id", "customer_id", "status", "amount", "timestamp", "_kafka_topic", "_kafka_partition",
    "_kafka_offset", "year", "month", "day",
)
METADATA_FIELDS = ("processing_timestamp", "kafka_topic", "kafka_partition", "kafka_offset", "processor_version")
ISO_START = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
TIME_PATH = r"/year=\d{4}/month=\d{2}/day=\d{2}/hour=\d{2}/[^/]*\.jsonl\z"
DEFAULT_PATH = r"/partition=\d+/[^/]*\.jsonl\z"
FILE_NAME = r"^\d{8}T\d{6}.*_[a-f0-9]{8}\.jsonl\z"
GOOD_NAME_SHARE = 0.8


def missing_columns(df: DataFrame, required: tuple[str, ...]) -> list[str]:
    return [c for c in required if c not in df.columns]


def column_report(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """(column_name, present, filled): each required column, whether ``df`` has it, and its values that are not null."""
    lost = set(missing_columns(df, required))
    counts = df.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c not in lost).alias("present"), (F.lit(0) if c in lost else F.count(c)).cast("bigint").alias("filled")) for c in required]).alias("c"))
    return counts.select(F.inline("c"))


def metadata_quality(lines: DataFrame, text: str = "value") -> DataFrame:
    """Counts over JSON Lines text: rows, metadata objects, complete ones, versions, original data."""
    doc = lines.select(F.try_parse_json(text).alias("_d"))
    at = lambda path: F.try_variant_get("_d", path, "string")
    complete = F.lit(True)
    for name in METADATA_FIELDS:
        complete = complete & at(f"$._metadata.{name}").isNotNull()
    has_meta = F.try_variant_get("_d", "$._metadata", "variant").isNotNull()
    original = at("$.user_id").isNotNull() | at("$.order_id").isNotNull() | at("$.event_type").isNotNull()
    return doc.agg(
        F.count("*").alias("total_rows"),
        F.count_if(has_meta).alias("with_metadata"),
        F.count_if(complete).alias("complete_metadata"),
        F.count_if(at("$._metadata.processor_version") == RECORD_VERSION).alias("expected_version"),
        F.count_if(at("$._metadata.processing_timestamp").rlike(ISO_START)).alias("iso_timestamp"),
        F.count_if(original).alias("with_original_data"),
    )


def classify_path(path: Column, topics: tuple[str, ...]) -> dict[str, Column]:
    """Layout class, topic, directory, extension and file-name check of a path."""
    name = F.regexp_extract(path, r"([^/]*)\z", 1)
    among = "/(" + "|".join(topics) + ")"
    topic = F.lit(None).cast("string")
    for t in reversed(topics):
        topic = F.when(path.contains(t), F.lit(t)).otherwise(topic)
    return {
        "layout": F.when(path.rlike(among + TIME_PATH), F.lit("time-based"))
        .when(path.rlike(among + DEFAULT_PATH), F.lit("default"))
        .otherwise(F.lit("other")),
        "path_topic": topic,
        "directory": F.regexp_extract(path, r"^(.*)/[^/]*\z", 1),
        "extension": F.regexp_extract(path, r"\.([^./]*)\z", 1),
        "valid_name": name.rlike(FILE_NAME),
    }


def path_report(files: DataFrame, topics: tuple[str, ...]) -> DataFrame:
    """Files per layout, topic and extension, with directories and the share of well-formed names."""
    marked = files.withColumns(classify_path(F.col("path"), topics))
    share = F.count_if("valid_name") / F.count("*")
    return marked.groupBy("layout", "path_topic", "extension").agg(
        F.count("*").alias("files"),
        F.countDistinct("directory").alias("directories"),
        F.count_if("valid_name").alias("valid_names"),
        F.round(share, 6).alias("valid_share"),
        (share > GOOD_NAME_SHARE).alias("names_ok"),
    )


def layout_report(files: DataFrame, commits: int) -> DataFrame:
    """One row about a table's files: number, bytes, partition directories, files per commit."""
    return files.agg(
        F.count("*").alias("data_files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.countDistinct(F.regexp_extract("path", r"^(.*)/[^/]*\z", 1)).alias("directories"),
        F.lit(commits).alias("commits"),
        (F.count("*") / F.lit(float(max(commits, 1)))).alias("files_per_commit"),
    )
