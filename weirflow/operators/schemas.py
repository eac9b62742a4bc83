"""Schema inference, evolution and compatibility."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.once import compute_once
from weirflow.functions.values import is_json_object

# Type names of the field table, and which old types a new type can read.
PROMOTIONS = {"BIGINT": ("BIGINT",), "DOUBLE": ("DOUBLE", "BIGINT"), "STRING": ("STRING", "BINARY"), "BINARY": ("BINARY", "STRING")}


def field_table(df: DataFrame, value: str = "value", keys: tuple[str, ...] = ("topic",)) -> DataFrame:
    """Top-level fields of JSON messages: presence, NULLs and the type that holds all their values.

    Counts per field and type combine on the map side; the result has one row per field.  Whole and
    fractional numbers merge to DOUBLE, any other conflict to STRING.
    """
    docs = compute_once(df, {"_doc": F.try_parse_json(value)})
    objects = docs.filter(is_json_object(F.col(value), F.col("_doc"))).select(*keys, "_doc")
    fields = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_doc").outer())).select(
        *keys, F.col("key").alias("field"), F.schema_of_variant("value").alias("_kind")
    )
    kind = F.col("_kind")
    counted = fields.groupBy(*keys, "field").agg(
        F.count("*").alias("present"),
        F.count_if(kind == "VOID").alias("nulls"),
        F.count_if(kind == "STRING").alias("_text"),
        F.count_if(kind == "BIGINT").alias("_whole"),
        F.count_if(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")).alias("_fraction"),
        F.count_if(kind == "BOOLEAN").alias("_bool"),
        F.count_if(kind.startswith("OBJECT")).alias("_object"),
        F.count_if(kind.startswith("ARRAY")).alias("_array"),
    )
    some = F.col("present") - F.col("nulls")
    merged = (
        F.when(some == 0, F.lit("STRING"))
        .when(F.col("_whole") == some, F.lit("BIGINT"))
        .when(F.col("_whole") + F.col("_fraction") == some, F.lit("DOUBLE"))
        .when(F.col("_bool") == some, F.lit("BOOLEAN"))
        .when(F.col("_object") == some, F.lit("OBJECT"))
        .when(F.col("_array") == some, F.lit("ARRAY"))
        .otherwise(F.lit("STRING"))
    )
    return counted.select(*keys, "field", "present", "nulls", merged.alias("type"))


def inferred_ddl(df: DataFrame, value: str = "value") -> DataFrame:
    """One row with the merged nested type of all messages, as Spark names it."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(value)).alias("variant_type"))


# A type word stands at the start, after a field's colon or as the element of an array; quoted names are passed over.
_TYPE_WORD = re.compile(r"`(?:[^`]|``)*`|(^|: |ARRAY<)(OBJECT|VARIANT|VOID)(?=[<>,]|$)")


def to_struct_type(variant_type: str) -> T.StructType:
    """The type text of :func:`inferred_ddl` as a schema; conflicts and pure NULLs become strings."""
    kinds = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}
    text = _TYPE_WORD.sub(lambda m: m[0] if m[2] is None else m[1] + kinds[m[2]], variant_type)
    parsed = T._parse_datatype_string(text)
    if not isinstance(parsed, T.StructType):
        raise ValueError(f"messages are not objects: {variant_type}")
    return parsed


def evolve(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of both; columns that one side lacks are NULL there."""
    return table.unionByName(batch, allowMissingColumns=True)


def compatibility(old: DataFrame, new: DataFrame) -> DataFrame:
    """Compare two field tables (field, type, required) by field.

    ``backward``: readers with the new schema can read old data; ``forward``: readers with the old
    schema can read new data; ``full``: both.
    """
    a = old.select("field", F.col("type").alias("old_type"), F.col("required").alias("old_required"))
    b = new.select("field", F.col("type").alias("new_type"), F.col("required").alias("new_required"))

    def readable(reader: str, writer: str):
        """Whether the reader's type accepts the writer's."""
        ok = F.col(reader) == F.col(writer)
        for kind, accepted in PROMOTIONS.items():
            ok = ok | ((F.col(reader) == kind) & F.col(writer).isin(*accepted))
        return ok

    added, removed = F.col("old_type").isNull(), F.col("new_type").isNull()
    backward = F.when(added, ~F.col("new_required")).when(removed, F.lit(True)).otherwise(readable("new_type", "old_type"))
    forward = F.when(removed, ~F.col("old_required")).when(added, F.lit(True)).otherwise(readable("old_type", "new_type"))
    return a.join(b, "field", "full_outer").select(
        "field",
        "old_type",
        "new_type",
        F.when(added, F.lit("added")).when(removed, F.lit("removed")).when(F.col("old_type") != F.col("new_type"), F.lit("changed")).otherwise(F.lit("same")).alias("change"),
        backward.alias("backward"),
        forward.alias("forward"),
        (backward & forward).alias("full"),
    )


def is_compatible(comparison: DataFrame, mode: str) -> DataFrame:
    """One row ``compatible`` for BACKWARD, FORWARD, FULL or NONE."""
    column = {"BACKWARD": "backward", "FORWARD": "forward", "FULL": "full"}.get(mode.upper())
    verdict = F.lit(True) if column is None else F.coalesce(F.bool_and(column), F.lit(True))
    return comparison.agg(verdict.alias("compatible"))
