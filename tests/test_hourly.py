import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, power, rows, weather
from tidemark.functions import date_parts
from tidemark.operators import (
    dedup,
    hour_bucket,
    hourly_join,
    hourly_summary,
    summarise_days,
    temp_demand_corr,
)
from tidemark.schemas import POWER_TIME_FORMAT, SUMMARY_SCHEMA, WEATHER_TIME_FORMAT

H10, H11 = dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5, 11)


def rows_first(power_rows, weather_rows):
    """The summary computed the plain way: join the rows, then aggregate."""
    # Without an id the survivor depends on the columns present: give the same.
    weather_rows = weather_rows.select("base_datetime", "temperature_c", "rainfall_mm")
    left = hour_bucket(dedup(power_rows), POWER_TIME_FORMAT)
    right = hour_bucket(dedup(weather_rows), WEATHER_TIME_FORMAT).drop("base_datetime")
    return (
        left.join(right, "hour_timestamp", "left_outer")
        .groupBy("hour_timestamp")
        .agg(
            F.avg("temperature_c").alias("avg_temp_c"),
            F.max("current_demand_mw").alias("max_demand_mw"),
            F.avg("reserve_power_mw").alias("avg_reserve_mw"),
            F.max("rainfall_mm").alias("max_rainfall_mm"),
        )
    )


def approx(found):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in found]


def test_summary_of_two_hours(spark):
    p = power(
        spark, ("20240105100000", 1.0, 10.0), ("20240105103000", 3.0, 20.0),
        ("20240105103000", 3.0, 20.0), ("20240105110000", 5.0, None),
    )
    w = weather(spark, ("202401051000", 0, 0.5, -3.0), ("202401051200", 1, 9.0, 9.0))
    assert rows(hourly_summary(p, w)) == [(H10, -3.0, 3.0, 15.0, 0.5), (H11, None, 5.0, None, None)]


def test_unreadable_times_form_one_unmatched_hour(spark):
    p = power(spark, ("junk", 1.0, 10.0), ("2024", 3.0, 20.0), (None, 7.0, 30.0))
    w = weather(spark, ("junk", 0, 0.5, -3.0), (None, 0, 0.5, -3.0))
    assert rows(hourly_summary(p, w)) == [(None, None, 7.0, 20.0, None)]


def test_nan_wins(spark):
    p = power(spark, ("20240105100000", float("nan"), 1.0), ("20240105100001", 3.0, float("nan")))
    assert rows(hourly_summary(p, weather(spark, ("x", 0, 0.0, 0.0)))) == [
        (H10, None, "NaN", "NaN", None)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_aggregating_first_equals_joining_first(spark, seed):
    """Several readings of both feeds in an hour, some hours in one feed only."""
    rng = random.Random(seed)

    def value():
        return rng.choice([None, float(rng.randint(-50, 50)), rng.randint(0, 99) / 8])

    p = power(
        spark, *[(f"202401{rng.randint(5, 6):02d}{rng.randint(0, 5):02d}{rng.randint(0, 59):02d}00", value(), value()) for _ in range(80)], ("bad", 1.0, 2.0),
    )
    w = weather(
        spark, *[(f"202401{rng.randint(5, 6):02d}{rng.randint(0, 7):02d}{rng.randint(0, 59):02d}", 0, value(), value()) for _ in range(25)], ("bad", 1, 1.0, 1.0),
    )
    assert approx(rows(hourly_summary(p, w))) == approx(rows(rows_first(p, w)))


def test_row_join_keeps_every_reading_and_pairs_within_the_hour(spark):
    p = power(
        spark, ("20240105100000", 1.0, 10.0), ("20240105103000", 2.0, 20.0),
        ("20240105110000", 3.0, 30.0), ("junk", 4.0, 40.0), (None, 5.0, 50.0),
    )
    w = weather(
        spark, ("202401051000", 0, 0.5, -3.0), ("202401051030", 1, 0.25, -4.0), ("junk", 9, 9.0, 9.0),
    )
    joined = hourly_join(p, w).select(
        "hour_timestamp", "base_datetime", "current_demand_mw", "rainfall_type", "temperature_c"
    )
    assert rows(joined) == sorted(
        [
            (H10, "20240105100000", 1.0, 0, -3.0), (H10, "20240105100000", 1.0, 1, -4.0),
            (H10, "20240105103000", 2.0, 0, -3.0), (H10, "20240105103000", 2.0, 1, -4.0),
            (H11, "20240105110000", 3.0, None, None),
            (None, "junk", 4.0, None, None), (None, None, 5.0, None, None),
        ],
        key=repr,
    )


def test_unreadable_times_spread_over_tasks(spark):
    """With a shuffled join no task gets all rows of the NULL hour."""
    p = spark.range(4000).select(
        F.concat(F.lit("x"), "id").alias("base_datetime"),
        F.lit(1.0).cast("float").alias("current_demand_mw"),
        F.lit(1.0).cast("float").alias("reserve_power_mw"),
    )
    w = weather(spark, ("202401051000", 0, 0.5, -3.0), ("x1", 1, 1.0, 1.0))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = hourly_join(p, w)
        sizes = [
            r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == 4000 and max(sizes) < 4000 / 4


def raw(frame):
    return frame.withColumns(date_parts(F.col("base_datetime")))


def test_days_summarised_together_equal_days_summarised_alone(spark):
    p = raw(power(
        spark, ("20240105100000", 1.0, 10.0), ("20240105xx", 2.0, 20.0), ("20240105yy", 4.0, 40.0),
        ("20240106100000", 3.0, 30.0), ("20240107100000", 9.0, 90.0),
    ))
    w = raw(weather(spark, ("202401051000", 0, 0.5, -3.0), ("202401061100", 0, 0.5, -5.0)))
    together = summarise_days(p, w)
    assert together.schema.names == SUMMARY_SCHEMA.names
    assert [f.dataType for f in together.schema] == [f.dataType for f in SUMMARY_SCHEMA]
    assert rows(together) == sorted(
        [
            (H10, -3.0, 1.0, 10.0, 0.5, 2024, "01", "05"),
            (None, None, 4.0, 30.0, None, 2024, "01", "05"),
            (dt.datetime(2024, 1, 6, 10), None, 3.0, 30.0, None, 2024, "01", "06"),
        ],
        key=repr,
    )
    alone = [
        r
        for day in ("05", "06", "07")
        for r in rows(summarise_days(p.filter(F.col("day") == day), w.filter(F.col("day") == day)))
    ]
    assert sorted(alone, key=repr) == rows(together)


def test_day_without_weather_only_on_request(spark):
    p, w = raw(power(spark, ("20240107100000", 9.0, 90.0))), raw(weather(spark, ("202401051000", 0, 0.5, -3.0)))
    assert rows(summarise_days(p, w)) == []
    assert rows(summarise_days(p, w, require_both=False)) == [
        (dt.datetime(2024, 1, 7, 10), None, 9.0, 90.0, None, 2024, "01", "07")
    ]


def test_correlation_over_hours_with_both(spark):
    summary = spark.createDataFrame(
        [(1.0, 10.0), (2.0, 20.0), (3.0, 30.0), (None, 5.0), (9.0, None)],
        "avg_temp_c double, max_demand_mw float",
    )
    assert approx(rows(temp_demand_corr(summary))) == [(3, 1.0)]


def test_summary_plan(spark):
    p = power(spark, ("20240105100000", 1.0, 10.0)).repartition(2)
    text = plan(hourly_summary(p, weather(spark, ("202401051000", 0, 0.5, -3.0))), "simple")
    assert "Python" not in text and "SortAggregate" not in text and "Window" not in text
    # Each feed shuffles its distinct times and then its hours; nothing else.
    assert text.count("Exchange hashpartitioning") <= 4
    join = text.index("Join")
    assert "partial_max" not in text[:join]
