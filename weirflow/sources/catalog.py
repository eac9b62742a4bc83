"""Schema catalog: a table of (subject, version, schema_id, schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATALOG = "subject string, version bigint, schema_id bigint, schema string"


def latest(catalog: DataFrame) -> DataFrame:
    """The newest schema of every subject."""
    return catalog.groupBy("subject").agg(
        F.max("version").alias("version"),
        F.max_by("schema_id", "version").alias("schema_id"),
        F.max_by("schema", "version").alias("schema"),
    )


def latest_of(catalog: DataFrame, subject: str) -> DataFrame:
    return latest(catalog.filter(F.col("subject") == subject))


def by_version(catalog: DataFrame, subject: str, version: int) -> DataFrame:
    return catalog.filter((F.col("subject") == subject) & (F.col("version") == version))


def by_id(catalog: DataFrame, schema_id: int) -> DataFrame:
    return catalog.filter(F.col("schema_id") == schema_id)


def subjects(catalog: DataFrame) -> DataFrame:
    return catalog.select("subject").distinct()


def register(catalog: DataFrame, subject: str, schema: str) -> DataFrame:
    """The row that registers ``schema``: the existing one if the text is known, else the next version.

    Write the result with append mode if ``is_new``.  One aggregate over the subject's rows, no window.
    """
    mine = F.col("subject") == subject
    known = mine & (F.col("schema") == schema)
    return catalog.agg(
        F.max(F.when(known, F.col("version"))).alias("_known_version"),
        F.max_by("schema_id", F.when(known, F.col("version"))).alias("_known_id"),
        F.coalesce(F.max(F.when(mine, F.col("version"))), F.lit(0)).alias("_last_version"),
        F.coalesce(F.max("schema_id"), F.lit(0)).alias("_last_id"),
    ).select(
        F.lit(subject).alias("subject"),
        F.coalesce("_known_version", F.col("_last_version") + 1).alias("version"),
        F.coalesce("_known_id", F.col("_last_id") + 1).alias("schema_id"),
        F.lit(schema).alias("schema"),
        F.col("_known_version").isNull().alias("is_new"),
    )
