"""Which days each feed covers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import DAY_COLUMNS


def day_presence(power: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per day of either raw table with a flag per feed.

    Only partition columns are read, and each task sends one row per day.
    """
    yes, no = F.lit(True), F.lit(False)
    marked = power.select(*DAY_COLUMNS, yes.alias("has_power"), no.alias("has_weather")).unionAll(
        weather.select(*DAY_COLUMNS, no.alias("has_power"), yes.alias("has_weather"))
    )
    return (
        marked.dropna(subset=DAY_COLUMNS)
        .groupBy(*DAY_COLUMNS)
        .agg(
            F.bool_or("has_power").alias("has_power"),
            F.bool_or("has_weather").alias("has_weather"),
        )
    )


def days_with_both(power: DataFrame, weather: DataFrame) -> DataFrame:
    """Days a summary can be made for."""
    both = F.col("has_power") & F.col("has_weather")
    return day_presence(power, weather).filter(both).select(*DAY_COLUMNS)


def days_skipped(power: DataFrame, weather: DataFrame) -> DataFrame:
    """Days only one feed covers, and which feed is missing."""
    missing = F.when(F.col("has_power"), "weather").otherwise("power")
    return (
        day_presence(power, weather)
        .filter(F.col("has_power") != F.col("has_weather"))
        .select(*DAY_COLUMNS, missing.alias("missing_feed"))
    )
