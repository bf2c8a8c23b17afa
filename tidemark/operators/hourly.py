"""Align both feeds on the hour and summarise."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timekeys import date_parts, event_hour
from tidemark.operators.columns import computed_once
from tidemark.operators.dedup import dedup
from tidemark.schemas import (
    DAY_COLUMNS,
    HOUR_COLUMN,
    POWER_TIME_FORMAT,
    SUMMARY_SCHEMA,
    WEATHER_TIME_FORMAT,
)


def hour_bucket(readings: DataFrame, pattern: str) -> DataFrame:
    """Add the hour of each reading; NULL where the event time is unreadable.

    The hour is fixed here: a join on it adds a filter for hours that are not
    NULL, which would otherwise sink below the dedup and parse every raw row.
    """
    hour = event_hour(F.col("base_datetime"), pattern)
    return computed_once(readings, {HOUR_COLUMN: hour}, "*")


def hourly_join(power: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join of deduplicated readings on the hour, row by row.

    A readable hour holds at most 3600 power and 60 weather event times, but
    any number of unreadable times share the NULL hour. Those match nothing, so
    each gets a key of its own instead of all going to one task: an hour is an
    even number of microseconds, the others get odd ones.
    """
    micros = F.unix_micros(HOUR_COLUMN)
    unreadable = F.shiftleft(F.xxhash64("base_datetime"), 1).bitwiseOR(F.lit(1).cast("long"))
    left = hour_bucket(power, POWER_TIME_FORMAT).withColumn(
        "_hour_key", F.coalesce(micros, unreadable)
    )
    right = (
        hour_bucket(weather, WEATHER_TIME_FORMAT)
        .withColumn("_hour_key", micros)
        .drop("base_datetime", HOUR_COLUMN)
    )
    return left.join(right, "_hour_key", "left_outer").drop("_hour_key")


def _summarise(power: DataFrame, weather: DataFrame, keys: list[str]) -> DataFrame:
    """Aggregate each feed per key, then join the hours.

    Joining rows first would pair every power row of an hour with every weather
    row of it. Each power row would then repeat equally often, as would each
    weather row, which changes neither an average nor a maximum: aggregating
    first gives the same figures and joins one row per hour.
    """
    power_hours = power.groupBy(*keys).agg(
        F.max("current_demand_mw").alias("max_demand_mw"),
        F.avg("reserve_power_mw").alias("avg_reserve_mw"),
    )
    weather_hours = weather.groupBy(*keys).agg(
        F.avg("temperature_c").alias("avg_temp_c"),
        F.max("rainfall_mm").alias("max_rainfall_mm"),
    )
    return power_hours.join(weather_hours, keys, "left_outer")


def hourly_summary(
    power: DataFrame, weather: DataFrame, tie_break: str | None = None
) -> DataFrame:
    """Hourly figures over all given readings, unreadable times as a NULL hour."""
    summary = _summarise(
        hour_bucket(_readings(power, "power", tie_break), POWER_TIME_FORMAT),
        hour_bucket(_readings(weather, "weather", tie_break), WEATHER_TIME_FORMAT),
        [HOUR_COLUMN],
    )
    return summary.select([f.name for f in SUMMARY_SCHEMA if f.name not in DAY_COLUMNS])


def summarise_days(
    power: DataFrame,
    weather: DataFrame,
    tie_break: str | None = None,
    require_both: bool = True,
) -> DataFrame:
    """Hourly figures of each day in the given raw tables, with the day columns.

    One plan gives what a job per day would: a day's unreadable times form the
    NULL hour of that day, and a day without weather is left out altogether
    unless ``require_both`` is off.
    """
    keys = [*DAY_COLUMNS, HOUR_COLUMN]
    # The raw tables' day columns are these very parts, so they need not travel
    # through the dedup shuffle.
    power_rows = _readings(power, "power", tie_break)
    weather_rows = _readings(weather, "weather", tie_break)
    summary = _summarise(
        hour_bucket(power_rows, POWER_TIME_FORMAT).withColumns(
            date_parts(F.col("base_datetime"))
        ),
        hour_bucket(weather_rows, WEATHER_TIME_FORMAT).withColumns(
            date_parts(F.col("base_datetime"))
        ),
        keys,
    )
    if require_both:
        # Partition columns only: no data column is read for this side. A semi
        # join would say the same, but it is pushed down to the raw rows, where
        # it may shuffle them all by day; an inner join stays with the hours.
        weather_days = weather.select(*DAY_COLUMNS).distinct()
        summary = summary.join(weather_days, DAY_COLUMNS)
    return summary.withColumn("year", F.col("year").try_cast("int")).select(
        SUMMARY_SCHEMA.names
    )


_MEASURES = {
    "power": ["current_demand_mw", "reserve_power_mw"],
    "weather": ["temperature_c", "rainfall_mm"],
}


def _readings(raw: DataFrame, feed: str, tie_break: str | None) -> DataFrame:
    """Deduplicated event times with the measures the summary needs."""
    return dedup(raw, tie_break=tie_break, carry=_MEASURES[feed])


def temp_demand_corr(summary: DataFrame) -> DataFrame:
    """Correlation of temperature and demand over the hours that have both."""
    both = summary.filter(F.col("avg_temp_c").isNotNull() & F.col("max_demand_mw").isNotNull())
    return both.agg(
        F.count("*").alias("n_hours"),
        F.corr("avg_temp_c", F.col("max_demand_mw").cast("double")).alias("temp_demand_corr"),
    )
