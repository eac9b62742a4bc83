"""Text-to-value conversions.  Each returns NULL where the text is not a value of the type.

The patterns are guards in front of Spark's casts, which accept more spellings (blanks, ``1d``,
``NaN``) than a message contract should.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a number, and which characters are trimmed (space and controls).
INTEGER_TEXT = r"^[+-]?[0-9]+\z"
DECIMAL_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
BLANKS = "".join(chr(i) for i in range(33))
# Numbers as most JVM producers print and read them: blanks around, NaN, Infinity, a type suffix.
LOOSE_DECIMAL_TEXT = r"^[+-]?(NaN|Infinity|([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)\z"


def trimmed(text: Column) -> Column:
    """Trim blanks and control characters at both ends, not only spaces.

    A look at both ends is several times faster than trimming, and rarely finds anything to trim.  The last
    byte is looked at: to find the last character all would be counted.
    """
    last = F.substring(text.cast("binary"), -1, 1)
    return F.when((text < "!") | (last < F.lit(b"!")), F.trim(text, F.lit(BLANKS))).otherwise(text)


def is_blank(text: Column) -> Column:
    """Nothing but blanks and control characters; decided at the first other character."""
    return (text < "!") & text.rlike(r"^[\x00-\x20]*\z")


def is_json_object(text: Column, parsed: Column) -> Column:
    """Whether ``parsed`` (the VARIANT of ``text``) is an object, seen from the first character."""
    return F.coalesce(parsed.isNotNull() & F.ltrim(text, F.lit(BLANKS)).startswith("{"), F.lit(False))


def strict_int(text: Column) -> Column:
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("int"))


def strict_long(text: Column) -> Column:
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))


def strict_double(text: Column) -> Column:
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double"))


def loose_double(text: Column) -> Column:
    """Double of a number in any JVM spelling (hexadecimal excepted); NaN stays NaN."""
    bare = trimmed(text)
    suffixed = F.when(bare.rlike(LOOSE_DECIMAL_TEXT), F.regexp_replace(bare, r"(?<=[0-9.])[fFdD]\z", "").try_cast("double"))
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double")).otherwise(suffixed)


def csv_boolean(text: Column) -> Column:
    """True only for the word "true" in any case; every other text is false."""
    return F.when(text.isNotNull(), F.lower(text) == "true")


def base64_bytes(text: Column) -> Column:
    return F.try_to_binary(text, F.lit("base64"))


def _strict_boolean(text: Column) -> Column:
    word = F.lower(text)
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def strict(text: Column, data_type: T.DataType, from_csv: bool = False) -> Column:
    """Convert text to ``data_type``; NULL means that the text is no such value."""
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.IntegerType):
        return strict_int(text)
    if isinstance(data_type, T.LongType):
        return strict_long(text)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return (loose_double(text) if from_csv else strict_double(text)).cast(data_type)
    if isinstance(data_type, T.BooleanType):
        return csv_boolean(text) if from_csv else _strict_boolean(text)
    if isinstance(data_type, T.BinaryType):
        return base64_bytes(text)
    if isinstance(data_type, T.DecimalType):
        return F.when(text.rlike(DECIMAL_TEXT), text.try_cast(data_type))
    if isinstance(data_type, T.DateType):
        return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date"))
    raise TypeError(f"no conversion from text to {data_type.simpleString()}")


def lenient(text: Column, data_type: T.DataType) -> Column:
    """Like :func:`strict`, but text that is no value becomes 0, 0.0 or false; NULL stays NULL.

    Whole numbers are cut from decimals, and numbers beyond the type end at its limits.
    """
    number = F.when(trimmed(text).rlike(DECIMAL_TEXT), trimmed(text).try_cast("double"))
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        wide = isinstance(data_type, T.LongType)
        low, high = (-(2**63), 2**63 - 1) if wide else (-(2**31), 2**31 - 1)
        exact = strict_long(trimmed(text)) if wide else strict_int(trimmed(text))
        cut = F.when(number >= high, F.lit(high)).when(number <= low, F.lit(low)).otherwise(number.try_cast("bigint"))
        value = F.coalesce(exact, cut.try_cast(data_type), F.lit(0).cast(data_type))
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        value = F.coalesce(number, F.lit(0.0)).cast(data_type)
    elif isinstance(data_type, T.BooleanType):
        value = (F.lower(trimmed(text)) == "true") | F.coalesce(number != 0, F.lit(False))
    else:
        return strict(text, data_type)
    return F.when(text.isNotNull(), value)
