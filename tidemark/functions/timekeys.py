"""Keys derived from event times.

Event times are local wall-clock strings without a zone; they are read in the
session time zone, so a job must pin spark.sql.session.timeZone and keep it.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import WEATHER_TIME_FORMAT


def event_time(text: Column, pattern: str) -> Column:
    """Timestamp of an event-time string; NULL where the text does not match."""
    return F.try_to_timestamp(text, F.lit(pattern))


def event_hour(text: Column, pattern: str) -> Column:
    """Start of the hour an event falls in."""
    return F.date_trunc("hour", event_time(text, pattern))


def date_parts(text: Column) -> dict[str, Column]:
    """Partition columns, taken by position so that both patterns work."""
    return {
        "year": F.substring(text, 1, 4),
        "month": F.substring(text, 5, 2),
        "day": F.substring(text, 7, 2),
    }


def calendar_parts(time: Column) -> dict[str, Column]:
    """Partition columns as integers, from a timestamp."""
    return {"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time)}


def target_day(run_time: Column) -> dict[str, Column]:
    """The day a run handles (the day before it) and its partition path."""
    day = F.date_sub(run_time, 1)
    return {
        "target_year": F.year(day),
        "target_month": F.date_format(day, "MM"),
        "target_day": F.date_format(day, "dd"),
        "partition_path": F.date_format(day, "'year='yyyy'/month='MM'/day='dd"),
    }


def publish_slot(fetched_at: Column) -> dict[str, Column]:
    """Observation slot current at a fetch: an hour is out ten minutes past it."""
    slot = F.date_trunc("hour", fetched_at - F.expr("INTERVAL 10 MINUTES"))
    return {
        "base_date": F.date_format(slot, "yyyyMMdd"),
        "base_time": F.date_format(slot, "HH'00'"),
        "base_datetime": F.date_format(slot, WEATHER_TIME_FORMAT),
    }

