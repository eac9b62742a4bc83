"""Content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.functions.values import trimmed

# A JSON string literal (kept) or blanks between tokens (dropped).  The possessive quantifiers keep
# the match free of recursion on long texts.
_STRING_OR_BLANK = r'("(?:[^"\\]++|\\.)*+")|[ \t\r\n]++'


def canonical_text(value: Column) -> Column:
    """Trimmed text; for valid JSON objects and arrays also without blanks between tokens."""
    text = trimmed(value)
    compact = F.regexp_replace(text, _STRING_OR_BLANK, "$1")
    return F.when(
        (text.startswith("{") | text.startswith("[")) & F.try_parse_json(text).isNotNull(), compact
    ).otherwise(text)


def content_fingerprint(value: Column) -> Column:
    return F.sha2(canonical_text(value), 256)


def offset_fingerprint(topic: Column, partition: Column, offset: Column) -> Column:
    return F.sha2(F.concat_ws(":", topic, partition.cast("string"), offset.cast("string")), 256)
