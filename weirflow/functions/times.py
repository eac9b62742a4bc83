"""Time handling: the timestamp cascade, business dates and literals for ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.functions.values import INTEGER_TEXT

# The accepted spellings of a point in time and of a business date.
INSTANT_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?([Zz]|[+-][0-9]{2}:[0-9]{2})\z"
LOCAL_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?\z"

DAY_MS = 24 * 60 * 60 * 1000


def epoch_ms(as_of: dt.datetime) -> int:
    """``as_of`` (UTC when it carries no zone) as epoch milliseconds."""
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return round(as_of.timestamp() * 1000)


def as_of_millis(as_of: dt.datetime) -> Column:
    return F.lit(epoch_ms(as_of)).cast("bigint")


def as_of_timestamp(as_of: dt.datetime) -> Column:
    return F.timestamp_millis(as_of_millis(as_of))


def as_of_date(as_of: dt.datetime) -> Column:
    return F.lit(dt.datetime.fromtimestamp(epoch_ms(as_of) / 1000, dt.timezone.utc).date())


def iso_text(as_of: dt.datetime) -> str:
    return dt.datetime.fromtimestamp(epoch_ms(as_of) / 1000, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _with_seconds(text: Column) -> Column:
    return F.when(F.length(text) == 16, F.concat(text, F.lit(":00"))).otherwise(text)


def parsed_millis(text: Column) -> Column:
    """Epoch milliseconds of ISO instants, epoch numbers and ISO local times (read as UTC)."""
    return (
        F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))
        .when(text.rlike(INSTANT_TEXT), F.unix_millis(F.try_to_timestamp(F.upper(text))))
        .when(text.rlike(LOCAL_TEXT), F.unix_millis(F.try_to_timestamp(F.concat(_with_seconds(F.upper(text)), F.lit("Z")))))
    )


def timestamp_cascade(text: Column, as_of: dt.datetime) -> Column:
    """:func:`parsed_millis`, and ``as_of`` for any other text; NULL stays NULL."""
    return F.when(text.isNotNull(), F.coalesce(parsed_millis(text), as_of_millis(as_of)))


def cob_date(cob: Column) -> Column:
    """The business date if the text is a strict ISO date, else NULL.

    Of ten bytes with dashes at these places and a digit at the end, the cast takes just ``yyyy-MM-dd``: a look
    at them costs less than a pattern.
    """
    at = lambda place: F.substring(cob, place, 1)
    strict = (F.octet_length(cob) == 10) & (at(5) == "-") & (at(8) == "-") & at(10).between("0", "9")
    return F.when(strict, cob.try_cast("date"))


def event_time(millis: Column) -> Column:
    return F.timestamp_millis(millis)
