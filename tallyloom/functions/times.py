"""Time expressions. Results are zone-less timestamps unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def floor_minutes(column: Column, minutes: int) -> Column:
    """Start of the time bucket of a zone-less timestamp."""
    return F.window(column, f"{minutes} minutes")["start"]


def calendar(column: Column) -> dict[str, Column]:
    """Calendar parts with Monday as day 0."""
    return {
        "year": F.year(column).cast("long"),
        "month": F.month(column).cast("long"),
        "day": F.day(column).cast("long"),
        "hour_of_day": F.hour(column).cast("long"),
        "day_of_week": F.weekday(column).cast("long"),
        "is_weekend": F.when(F.weekday(column) >= 5, 1).otherwise(0).cast("long"),
    }


def parse_moment(column: Column, naive_offset: str = "+08:00") -> Column:
    """Instant of an ISO text; text without a zone is taken at the offset."""
    text = F.trim(column)
    zoned = F.when(text.rlike(_ZONE), text).otherwise(F.concat(text, F.lit(naive_offset)))
    return zoned.try_cast("timestamp")


def local_text(moment: Column, offset: str = "+08:00") -> Column:
    """ISO seconds at an offset."""
    local = F.from_utc_timestamp(moment, offset)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(offset))


def local_clock(moment: Column, offset: str = "+08:00") -> Column:
    """Wall-clock time of an instant at an offset, zone dropped."""
    return F.from_utc_timestamp(moment, offset).cast("timestamp_ntz")


def wall_clock(column: Column) -> Column:
    """Wall-clock time as written; the offset is cut off, not applied."""
    return F.regexp_replace(F.trim(column), _ZONE, "").try_cast("timestamp_ntz")


def file_stamp(column: Column) -> Column:
    return F.date_format(column, "yyyyMMdd_HHmmss")


def iso_seconds(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
