"""Summary jobs over the raw tables ``<lake>/power`` and ``<lake>/weather``."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.hourly import hourly_summary, summarise_days
from tidemark.schemas import DAY_COLUMNS, POWER_SCHEMA, WEATHER_SCHEMA, with_id
from tidemark.sources.lake import (
    append_state,
    days_since,
    days_touched,
    last_batch,
    read_days,
    read_raw,
    read_state,
    within,
    write_days,
)

FEEDS = ("power", "weather")


def summary_range(
    spark: SparkSession,
    lake: str,
    start: dt.date | None,
    end: dt.date | None,
    require_both: bool = True,
    tie_break: str | None = None,
) -> DataFrame:
    """Summary of every day from start to end, in one job; None leaves an end open."""
    power_schema, weather_schema = _schemas(tie_break)
    power = read_days(spark, f"{lake}/power", power_schema, start, end)
    weather = read_days(spark, f"{lake}/weather", weather_schema, start, end)
    return summarise_days(power, weather, tie_break, require_both)


def daily_summary(
    spark: SparkSession,
    lake: str,
    run_date: dt.date,
    require_both: bool = True,
    tie_break: str | None = None,
) -> DataFrame:
    """Summary of the day before the run date; no rows if a feed lacks the day."""
    day = run_date - dt.timedelta(days=1)
    return summary_range(spark, lake, day, day, require_both, tie_break)


def write_range(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    start: dt.date | None,
    end: dt.date | None,
    mode: str = "replace",
    require_both: bool = True,
    tie_break: str | None = None,
) -> None:
    """Summarise every day of the range into the warehouse table.

    In mode ``replace`` the table then holds of the range what the raw tables give:
    a day that no longer gives any rows is removed.
    """
    summary = summary_range(spark, lake, start, end, require_both, tie_break)
    write_days(summary, warehouse, mode, within(start, end))


def write_daily_summary(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    run_date: dt.date,
    mode: str = "replace",
    require_both: bool = True,
    tie_break: str | None = None,
) -> None:
    """Summarise the day before the run date into the warehouse table."""
    day = run_date - dt.timedelta(days=1)
    write_range(spark, lake, warehouse, day, day, mode, require_both, tie_break)


def write_changed_days(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    since: dict[str, dt.datetime | None],
    require_both: bool = True,
    tie_break: str | None = None,
) -> list[dt.date]:
    """Summarise again the days that either raw table got files for since a time; those days.

    ``since`` has a time for each feed, as ``last_change`` gave it before; None
    takes all days. Only the folders of the days are read and written. Days of files
    of that very time are written again. For tables without a log of batches; with
    one ``write_touched_days`` takes each batch once.
    """
    schemas = dict(zip(FEEDS, _schemas(tie_break), strict=True))
    always = dt.datetime(1, 1, 2)
    changed = {
        day
        for feed, schema in schemas.items()
        for day in days_since(spark, f"{lake}/{feed}", schema, since.get(feed) or always)
    }
    return _write_days_again(spark, lake, warehouse, changed, require_both, tie_break)


def write_touched_days(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    log: str,
    state: str,
    require_both: bool = True,
    tie_break: str | None = None,
) -> list[dt.date]:
    """Summarise again the days that batches landed since the last time have touched; those days.

    ``log`` has a log of batches for each feed, ``state`` remembers up to which one
    has been summarised. That is written last, so a run that fails is made good by
    the next. Batches that land meanwhile are left to the next run, too.
    """
    done = read_state(spark, state)
    upto = {feed: last_batch(spark, f"{log}/{feed}") for feed in FEEDS}
    touched = {
        day for feed in FEEDS for day in days_touched(spark, f"{log}/{feed}", done.get(feed, -1), upto[feed])
    }
    days = _write_days_again(spark, lake, warehouse, touched, require_both, tie_break)
    if any(upto[feed] > done.get(feed, -1) for feed in FEEDS):
        append_state(spark, state, upto)
    return days


def _write_days_again(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    chosen: set[tuple],
    require_both: bool,
    tie_break: str | None,
) -> list[dt.date]:
    """Summarise some days of the raw tables, given as their column values, and replace them."""
    days = {day for day in map(_date, chosen) if day is not None}
    if not days:
        return []
    wanted = F.struct(*DAY_COLUMNS).isin([F.struct(*map(F.lit, day)) for day in sorted(chosen)])
    power, weather = (
        read_raw(spark, f"{lake}/{feed}", schema).filter(wanted)
        for feed, schema in zip(FEEDS, _schemas(tie_break), strict=True)
    )
    summary = summarise_days(power, weather, tie_break, require_both)
    write_days(summary, warehouse, stands_for=days.__contains__)
    return sorted(days)


def _date(parts: tuple[str, ...]) -> dt.date | None:
    try:
        return dt.date(*map(int, parts))
    except ValueError:
        return None


def full_scan_summary(
    spark: SparkSession, lake: str, tie_break: str | None = None
) -> DataFrame:
    """Summary of everything ever landed, unreadable times as one NULL hour."""
    power_schema, weather_schema = _schemas(tie_break)
    power = read_raw(spark, f"{lake}/power", power_schema)
    weather = read_raw(spark, f"{lake}/weather", weather_schema)
    return hourly_summary(power, weather, tie_break)


def _schemas(tie_break: str | None) -> tuple[StructType, StructType]:
    return with_id(POWER_SCHEMA, tie_break), with_id(WEATHER_SCHEMA, tie_break)
