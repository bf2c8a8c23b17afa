"""Every schema the package uses, declared once so that nothing is inferred."""

from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Field names and types of the two message kinds.
POWER_SCHEMA = StructType(
    [
        StructField("base_datetime", StringType()),
        StructField("current_demand_mw", FloatType()),
        StructField("reserve_power_mw", FloatType()),
    ]
)
WEATHER_SCHEMA = StructType(
    [
        StructField("base_datetime", StringType()),
        StructField("rainfall_type", IntegerType()),
        StructField("rainfall_mm", FloatType()),
        StructField("temperature_c", FloatType()),
    ]
)

# Event-time patterns; the feeds differ in the seconds.
POWER_TIME_FORMAT = "yyyyMMddHHmmss"
WEATHER_TIME_FORMAT = "yyyyMMddHHmm"

# Partition columns of every date-partitioned table.
DAY_COLUMNS = ["year", "month", "day"]

HOUR_COLUMN = "hour_timestamp"

SUMMARY_SCHEMA = StructType(
    [
        StructField(HOUR_COLUMN, TimestampType()),
        StructField("avg_temp_c", DoubleType()),
        StructField("max_demand_mw", FloatType()),
        StructField("avg_reserve_mw", DoubleType()),
        StructField("max_rainfall_mm", FloatType()),
        StructField("year", IntegerType()),
        StructField("month", StringType()),
        StructField("day", StringType()),
    ]
)


def raw_schema(message: StructType) -> StructType:
    """Schema of a raw table: the message plus zero-padded string date parts.

    Reading a partitioned root without it would infer INT and turn "05" into 5.
    """
    return StructType(message.fields + [StructField(c, StringType()) for c in DAY_COLUMNS])


def with_id(message: StructType, name: str | None) -> StructType:
    """The message with a whole-number id, for feeds that number their readings."""
    return StructType(message.fields + [StructField(name, LongType())]) if name else message
