"""Column expressions shared by batch and streaming operators.

All of them are built-in Spark expressions, so they stay inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatewatch.schema import UNKNOWN


def is_kind(*kinds: str) -> Column:
    event_type = F.col("event_type")
    return event_type == kinds[0] if len(kinds) == 1 else event_type.isin(*kinds)


# The milliseconds of 0001-01-01 and of the end of 9999-12-31.
FIRST_MILLIS, LAST_MILLIS = -62135596800000, 253402300799999


def event_time_from(text: Column) -> Column:
    """Epoch milliseconds or ISO-8601 text to a timestamp of the years 1 to 9999.

    NULL for anything else; micro- and nanoseconds lie beyond the range.
    """
    # The digits test first: a try_cast that fails is much dearer than a match.
    is_number = text.rlike("^[+-]?[0-9]+$")
    millis = text.try_cast("bigint")
    in_range = F.when(millis.between(FIRST_MILLIS, LAST_MILLIS), millis)
    parsed = F.try_to_timestamp(text)
    return (F.when(is_number, F.timestamp_millis(in_range))
            .otherwise(F.when(F.year(parsed).between(1, 9999), parsed)))


def iso_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def or_unknown(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(UNKNOWN))


def success_count() -> Column:
    """Number of rows with ``success``; a NULL counts as not successful."""
    return F.sum(F.when(F.col("success"), 1).otherwise(0))


def has_location() -> Column:
    return F.coalesce(F.col("city"), F.col("latitude").cast("string"),
                      F.col("longitude").cast("string")).isNotNull()


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)
