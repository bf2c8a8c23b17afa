import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from tidemark.functions import (
    calendar_parts,
    date_parts,
    event_hour,
    event_time,
    publish_slot,
    target_day,
)
from tidemark.schemas import POWER_TIME_FORMAT, WEATHER_TIME_FORMAT


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def times(spark, *values):
    return spark.createDataFrame([(dt.datetime.fromisoformat(v),) for v in values], "t timestamp")


def test_event_hour_of_both_patterns(spark):
    power = texts(spark, "20251122222500").select(event_hour(F.col("t"), POWER_TIME_FORMAT))
    weather = texts(spark, "202511221200").select(event_hour(F.col("t"), WEATHER_TIME_FORMAT))
    assert rows(power) == [(dt.datetime(2025, 11, 22, 22),)]
    assert rows(weather) == [(dt.datetime(2025, 11, 22, 12),)]


def test_event_time_is_null_where_unreadable(spark):
    bad = texts(spark, "junk", "", None, "202511221200", "20251322000000", "20251122226000")
    assert rows(bad.select(event_time(F.col("t"), POWER_TIME_FORMAT))) == [(None,)] * 6


def test_date_parts_go_by_position(spark):
    cut = texts(spark, "20251122222500", "202511221200", "2025", "", None)
    assert rows(cut.select("t", *date_parts(F.col("t")).values())) == sorted(
        [
            ("20251122222500", "2025", "11", "22"),
            ("202511221200", "2025", "11", "22"),
            ("2025", "2025", "", ""),
            ("", "", "", ""),
            (None, None, None, None),
        ],
        key=repr,
    )


def test_calendar_parts_are_numbers(spark):
    assert rows(times(spark, "2025-01-05 10:00:00").select(*calendar_parts(F.col("t")).values())) == [
        (2025, 1, 5)
    ]


def test_target_day_is_the_day_before(spark):
    runs = times(spark, "2024-03-01 00:00:01", "2025-01-01 23:59:59")
    assert rows(runs.select(*target_day(F.col("t")).values())) == [
        (2024, "02", "29", "year=2024/month=02/day=29"),
        (2024, "12", "31", "year=2024/month=12/day=31"),
    ]


def test_publish_slot_turns_over_ten_minutes_past(spark):
    fetches = times(spark, "2025-01-01 00:09:59", "2025-01-01 00:10:00", "2025-01-01 15:59:59")
    assert rows(fetches.select(*publish_slot(F.col("t")).values())) == [
        ("20241231", "2300", "202412312300"),
        ("20250101", "0000", "202501010000"),
        ("20250101", "1500", "202501011500"),
    ]
