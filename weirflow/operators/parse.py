"""Parsing: format detection, JSON and CSV records, typed conversion with one error per row.

A message is parsed once, by ``from_json`` or ``from_csv``, into a record whose scalar leaves are
all text.  The text is then converted by guarded casts, so a bad number names its field instead of
spoiling the whole record.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.config import TopicConfig
from weirflow.functions import values
from weirflow.functions.once import compute_once
from weirflow.functions.times import as_of_date, as_of_millis, timestamp_cascade

JSON, CSV = "JSON", "CSV"
_BROKEN = "_broken"
_COB_DATE = "cob_date"
_CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": "\\",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def detect_format(value: Column) -> Column:
    """Braces or brackets around the text mean JSON; a comma without any of them means CSV."""
    text = values.trimmed(value)
    wrapped = (text.startswith("{") & text.endswith("}")) | (text.startswith("[") & text.endswith("]"))
    plain_list = text.contains(",") & ~text.contains("{") & ~text.contains("[")
    return F.when(~wrapped & plain_list, F.lit(CSV)).otherwise(F.lit(JSON))


def text_schema(data_type: T.DataType) -> T.DataType:
    """The same nesting with text leaves."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, text_schema(f.dataType), True) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(text_schema(data_type.elementType), True)
    if isinstance(data_type, T.MapType):
        return T.MapType(T.StringType(), text_schema(data_type.valueType), True)
    return T.StringType()


def _is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StructType, T.ArrayType, T.MapType))


def _is_millis(field: T.StructField) -> bool:
    return field.metadata.get("logical") == "timestamp-millis"


def _converted(text: Column, field: T.StructField, as_of: dt.datetime, lenient: bool) -> Column:
    """JSON text (or nested text) of one field as its declared type."""
    kind = field.dataType
    if isinstance(kind, T.StructType):
        members = [_converted(text[m.name], m, as_of, lenient).alias(m.name) for m in kind.fields]
        return F.when(text.isNotNull(), F.struct(*members))
    if isinstance(kind, T.ArrayType):
        element = T.StructField("element", kind.elementType)
        return F.transform(text, lambda x: _converted(x, element, as_of, lenient))
    if isinstance(kind, T.MapType):
        value = T.StructField("value", kind.valueType)
        if isinstance(kind.valueType, T.StringType):
            return text
        return F.transform_values(text, lambda k, x: _converted(x, value, as_of, lenient))
    if _is_millis(field):
        return timestamp_cascade(text, as_of)
    return values.lenient(text, kind) if lenient else values.strict(text, kind)


def _has_bad_value(text: Column, field: T.StructField, as_of: dt.datetime) -> Column | None:
    """Whether text is present that is no value of the declared type; None if that cannot happen."""
    kind = field.dataType
    if isinstance(kind, T.StringType) or _is_millis(field):
        return None
    if isinstance(kind, T.StructType):
        parts = [_has_bad_value(text[m.name], m, as_of) for m in kind.fields]
        return _any([p for p in parts if p is not None])
    if isinstance(kind, (T.ArrayType, T.MapType)):
        inner = T.StructField("element", kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType)
        if _has_bad_value(F.lit(None).cast(text_schema(inner.dataType)), inner, as_of) is None:
            return None
        items = text if isinstance(kind, T.ArrayType) else F.map_values(text)
        return F.coalesce(F.exists(items, lambda x: F.coalesce(_has_bad_value(x, inner, as_of), F.lit(False))), F.lit(False))
    return text.isNotNull() & values.strict(text, kind).isNull()


def _any(conditions: list[Column]) -> Column | None:
    return reduce(lambda a, b: a | b, conditions) if conditions else None


def _with_default(value: Column, field: T.StructField) -> Column:
    if "default" not in field.metadata:
        return value
    default = field.metadata["default"]
    if isinstance(field.dataType, T.MapType) and default == {}:
        return F.coalesce(value, F.create_map().cast(field.dataType))
    return F.coalesce(value, F.lit(default).cast(field.dataType))


def _csv_text(cell: Column, field: T.StructField) -> Column:
    """A trimmed CSV cell; in a nullable field the word "null" and the empty cell are NULL."""
    empty = (cell == "") | (F.lower(cell) == "null") if field.nullable else cell == ""
    return F.when(~empty, cell)


def _broken_csv(value: Column) -> Column:
    """A quoted cell is still open at the end of the text."""
    bare = F.regexp_replace(value, r"\\.", "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2 == 1


def _first_line(value: Column) -> Column:
    """The first non-empty CSV line; line breaks inside quotes do not end it."""
    text = F.ltrim(value, F.lit(values.BLANKS))
    line = F.regexp_extract(text, r'^(?:[^"\r\n]++|"(?:[^"\\]++|\\.)*+")*+', 0)
    return F.when(text.contains("\n") | text.contains("\r"), line).otherwise(value)


def with_raw(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add ``format``, ``_json`` and ``_csv``: each message goes through exactly one parser."""
    fields = [T.StructField(f.name, text_schema(f.dataType), True) for f in schema.fields]
    extra = [] if _COB_DATE in schema.names else [T.StructField(_COB_DATE, T.StringType(), True)]
    json_schema = T.StructType([*fields, *extra, T.StructField(_BROKEN, T.StringType(), True)])
    csv_schema = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    return (
        df.withColumn("format", detect_format(F.col("value")))
        .withColumn("_json", F.when(F.col("format") == JSON, F.from_json("value", json_schema, options)))
        .withColumn("_csv", F.when(F.col("format") == CSV, F.from_csv(_first_line(F.col("value")), csv_schema, _CSV_OPTIONS)))
    )


def parse(df: DataFrame, topic: TopicConfig, as_of: dt.datetime) -> DataFrame:
    """Envelopes -> envelopes plus ``format``, ``rec``, ``cob`` and ``parse_error`` (NULL = parsed).

    In steps, each computed once per row from the one before: trimmed cells, the text of each field
    from either format, values, and the record with its error.  Small steps keep each generated
    method within what the JVM compiles.
    """
    fields, is_csv = topic.schema.fields, F.col("format") == CSV
    raw = with_raw(df, topic.schema)
    cells = compute_once(raw, {"_cells": F.struct(*[values.trimmed(F.col("_csv")[f.name]).alias(f.name) for f in fields])})

    chosen = []
    for field in fields:
        cell = _csv_text(F.col("_cells")[field.name], field)
        if _is_nested(field.dataType):
            cell = F.from_json(cell, text_schema(field.dataType))
        chosen.append(F.when(is_csv, cell).otherwise(F.col("_json")[field.name]).alias(field.name))
    texts = compute_once(cells, {"_text": F.struct(*chosen)})
    converted = [_value(F.col("_text")[f.name], f, topic.lenient, is_csv, as_of).alias(f.name) for f in fields]
    valued = compute_once(texts, {"_value": F.struct(*converted)})

    errors = []
    for field in fields:
        bad = _bad(field, topic.lenient, is_csv, as_of)
        if bad is not None:
            errors.append(F.when(bad, F.lit(f"bad_field:{field.name}")))
    error = F.coalesce(
        F.when(F.col("value").isNull(), F.lit("null_value")),
        F.when(values.is_blank(F.col("value")), F.lit("empty_message")),
        F.when(~is_csv & (F.col("_json").isNull() | F.col("_json")[_BROKEN].isNotNull()), F.lit("malformed_json")),
        F.when(is_csv & _broken_csv(F.col("value")), F.lit("malformed_csv")),
        *errors,
        F.lit(None).cast("string"),
    )
    members = []
    for field in fields:
        value = _with_default(F.col("_value")[field.name], field)
        members.append((_filled_cob(value, topic.schema, as_of) if field.name == "cob" else value).alias(field.name))
    rec = F.struct(*members)
    cob = rec["cob"] if "cob" in topic.schema.names else _filled_cob(F.lit(None).cast("string"), topic.schema, as_of)
    return compute_once(valued, {"rec": rec, "cob": cob, "parse_error": error}).drop("_json", "_csv", "_cells", "_text", "_value")


def _value(text: Column, field: T.StructField, lenient: bool, is_csv: Column, as_of: dt.datetime) -> Column:
    """The text of one field as its declared type, by the rules of the message's format."""
    kind = field.dataType
    if _is_nested(kind) or isinstance(kind, T.StringType) or _is_millis(field):
        return _converted(text, field, as_of, lenient)
    if lenient:
        return F.when(is_csv, values.strict(text, kind, from_csv=True)).otherwise(values.lenient(text, kind))
    if isinstance(kind, (T.DoubleType, T.FloatType, T.BooleanType)):
        return F.when(is_csv, values.strict(text, kind, from_csv=True)).otherwise(values.strict(text, kind))
    return values.strict(text, kind)


def _bad(field: T.StructField, lenient: bool, is_csv: Column, as_of: dt.datetime) -> Column | None:
    """Whether a field has text that is no value of its type; None if that cannot happen."""
    text, kind = F.col("_text")[field.name], field.dataType
    if _is_nested(kind):
        lost = is_csv & _csv_text(F.col("_cells")[field.name], field).isNotNull() & text.isNull()
        inside = None if lenient else _has_bad_value(text, field, as_of)
        return lost if inside is None else lost | inside
    if isinstance(kind, T.StringType) or _is_millis(field):
        return None
    bad = text.isNotNull() & F.col("_value")[field.name].isNull()
    return is_csv & bad if lenient else bad


def _filled_cob(cob: Column, schema: T.StructType, as_of: dt.datetime) -> Column:
    """The business date: the field itself, else ``cob_date`` of JSON, else the first CSV column,
    else the day of ``as_of``."""
    return F.coalesce(
        cob,
        F.col("_json")[_COB_DATE],
        F.col("_cells")[schema.fields[0].name],
        F.date_format(as_of_date(as_of), "yyyy-MM-dd"),
    )


def parsed_only(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parse_error").isNull())


def parse_failures(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parse_error").isNotNull())


def parse_variant(df: DataFrame) -> DataFrame:
    """Add ``doc``: the JSON object as VARIANT; NULL if the text is not a JSON object."""
    doc = F.try_parse_json("value")
    return df.withColumn("doc", F.when(values.is_json_object(F.col("value"), doc), doc))


def wire_header(df: DataFrame, source: str = "value") -> DataFrame:
    """Read the binary framing of registered schemas: a zero byte and a 4-byte schema id.

    ``wire_kind`` is ``framed``, ``too_short``, ``bad_magic`` or ``not_base64`` (then it is JSON text).
    """
    framed = df.withColumn("_b", values.base64_bytes(F.col(source)))
    number = F.conv(F.hex(F.substring("_b", 2, 4)), 16, 10).cast("bigint")
    kind = (
        F.when(F.col("_b").isNull(), F.lit("not_base64"))
        .when(F.octet_length("_b") < 5, F.lit("too_short"))
        .when(F.hex(F.substring("_b", 1, 1)) != "00", F.lit("bad_magic"))
        .otherwise(F.lit("framed"))
    )
    good = F.col("wire_kind") == "framed"
    return (
        framed.withColumn("wire_kind", kind)
        .withColumn("schema_id", F.when(good, number))
        .withColumn("payload", F.when(good, F.expr("substring(_b, 6)")))
        .drop("_b")
    )


def to_table_rows(parsed: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Accepted records as table rows: the record's fields, the processing time and the business date."""
    return parsed.select("rec.*", as_of_millis(as_of).alias("processed_timestamp"), F.col("cob").alias("cob_date"))
