"""The summary against a model in plain Python, and under changes that must not matter."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import power, rows, weather
from tidemark.functions import date_parts, event_hour
from tidemark.operators import dedup, hourly_join, hourly_summary, summarise_days
from tidemark.schemas import POWER_TIME_FORMAT


def readings(seed, count, digits):
    """Readings of three days with repeats, gaps in values and damaged times."""
    rng = random.Random(seed)

    def value():
        return rng.choice([None, float(rng.randint(0, 9)), rng.randint(0, 40) / 4])

    def time():
        day, hour, minute = rng.randint(5, 7), rng.randint(0, 2), rng.choice([0, 15, 30])
        whole = f"202401{day:02d}{hour:02d}{minute:02d}" + "00" * (digits == 14)
        return rng.choice([whole] * 8 + [whole[:9], whole[:8] + "xx", "junk", "", None])

    return [(time(), value(), value(), i) for i in rng.sample(range(count * 2), count)]


def first_by_id(found):
    kept = {}
    for reading in sorted(found, key=lambda r: r[3]):
        kept.setdefault(reading[0], reading)
    return kept.values()


def hour_of(text, pattern):
    try:
        return dt.datetime.strptime(text, pattern).replace(minute=0, second=0)
    except (TypeError, ValueError):
        return None


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def highest(values):
    known = [v for v in values if v is not None]
    return max(known) if known else None


def grouped(found, pattern, length, by_day):
    groups = defaultdict(list)
    for reading in first_by_id(found):
        text = reading[0]
        hour = hour_of(text, pattern) if text and len(text) == length else None
        day = (text[:4], text[4:6], text[6:8]) if text is not None else (None,) * 3
        groups[(day if by_day else None, hour)].append(reading)
    return groups


def model(power_readings, weather_readings, by_day):
    weather_groups = grouped(weather_readings, "%Y%m%d%H%M", 12, by_day)
    result = {}
    for key, group in grouped(power_readings, "%Y%m%d%H%M%S", 14, by_day).items():
        matched = weather_groups.get(key, []) if key[1] is not None else []
        result[key] = (
            mean([r[2] for r in matched]),
            highest([r[1] for r in group]),
            mean([r[2] for r in group]),
            highest([r[1] for r in matched]),
        )
    return result


def frames(spark, power_readings, weather_readings):
    """Weather readings carry (time, rain, temperature, id)."""
    return (
        power(spark, *power_readings, id_column=True),
        weather(spark, *[(t, 0, rain, warm, i) for t, rain, warm, i in weather_readings], id_column=True),
    )


def approx(values):
    return tuple(None if v is None else round(v, 6) for v in values)


@pytest.mark.parametrize("seed", range(6))
def test_hourly_summary_against_model(spark, seed):
    given = readings(seed, 150, 14), readings(seed + 100, 40, 12)
    p, w = frames(spark, *given)
    found = {(None, r[0]): approx(r[1:]) for r in rows(hourly_summary(p, w, "id"))}
    assert found == {k: approx(v) for k, v in model(*given, by_day=False).items()}


@pytest.mark.parametrize("seed", range(6))
def test_days_against_model(spark, seed):
    given = readings(seed, 150, 14), [r for r in readings(seed + 100, 40, 12) if r[0] is None or r[0][6:8] != "07"]
    p, w = (f.withColumns(date_parts(F.col("base_datetime"))) for f in frames(spark, *given))
    found = {
        ((str(r[5]), r[6], r[7]), r[0]): approx(r[1:5])
        for r in rows(summarise_days(p, w, "id").filter("year = 2024"))
    }
    days = {(t[:4], t[4:6], t[6:8]) for t, *_ in given[1] if t and t.startswith("2024")}
    assert len(days) == 2
    expected = {k: approx(v) for k, v in model(*given, by_day=True).items() if k[0] in days}
    assert found == expected


@pytest.mark.parametrize("tasks", [1, 7])
def test_summary_ignores_order_repeats_and_spread(spark, tasks):
    given = readings(1, 150, 14), readings(2, 40, 12)
    reference = rows(hourly_summary(*frames(spark, *given), "id"))
    changed = [random.Random(tasks).sample(r * 3, len(r) * 3) for r in given]
    p, w = (f.repartition(tasks) for f in frames(spark, *changed))
    found = rows(hourly_summary(p, w, "id"))
    assert [(r[0], approx(r[1:])) for r in found] == [(r[0], approx(r[1:])) for r in reference]


@pytest.mark.parametrize("zone", ["Asia/Seoul", "Asia/Kolkata", "America/New_York"])
def test_wall_clock_hours_in_other_zones(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        p = power(spark, ("20240105103000", 1.0, 10.0), ("junk", 2.0, 20.0))
        w = weather(spark, ("202401051000", 0, 0.5, -3.0), ("202401051100", 0, 1.5, 3.0))
        hour = event_hour(F.col("base_datetime"), POWER_TIME_FORMAT)
        shown = [r[0] for r in p.select(F.date_format(hour, "yyyyMMddHHmm")).collect()]
        joined = rows(hourly_join(dedup(p), dedup(w)).select("base_datetime", "rainfall_mm"))
        summary = rows(hourly_summary(p, w).select("avg_temp_c", "max_demand_mw"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert shown == ["202401051000", None]
    assert joined == [("20240105103000", 0.5), ("junk", None)]
    assert summary == [(-3.0, 1.0), (None, 2.0)]
