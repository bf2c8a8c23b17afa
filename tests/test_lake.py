import datetime as dt
import glob
import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import plan, power, rows, weather
from tidemark.functions import date_parts
from tidemark.operators import day_presence, days_skipped, days_with_both
from tidemark.plans import (
    daily_summary,
    full_scan_summary,
    summary_range,
    write_changed_days,
    write_daily_summary,
    write_range,
)
from tidemark.schemas import DAY_COLUMNS, POWER_SCHEMA, WEATHER_SCHEMA, raw_schema
from tidemark.sources import last_change, read_days, read_raw, read_summary, write_days

DAY = dt.date(2024, 1, 5)


def raw(frame):
    return frame.withColumns(date_parts(F.col("base_datetime")))


@pytest.fixture
def lake(spark, folder):
    p = power(
        spark, ("20240105100000", 1.0, 10.0), ("20240105100000", 1.0, 10.0),
        ("20240105103000", 3.0, 20.0), ("20240106100000", 3.0, 30.0),
        ("20240107100000", 9.0, 90.0), ("2024", 5.0, 50.0), (None, 6.0, 60.0),
    )
    w = weather(
        spark, ("202401051000", 0, 0.5, -3.0), ("202401061100", 0, 0.5, -5.0),
        ("202401081100", 0, 0.5, -5.0),
    )
    write_days(raw(p), f"{folder}/power")
    write_days(raw(w), f"{folder}/weather")
    return folder


def test_date_parts_stay_padded_text(spark, lake):
    table = read_raw(spark, f"{lake}/power", POWER_SCHEMA)
    assert table.schema.names == raw_schema(POWER_SCHEMA).names
    assert rows(table.select(*DAY_COLUMNS).distinct()) == sorted(
        [("2024", "01", "05"), ("2024", "01", "06"), ("2024", "01", "07"), ("2024", None, None), (None,) * 3],
        key=repr,
    )
    assert table.count() == 7


def test_days_are_read_by_partition(spark, lake):
    one = read_days(spark, f"{lake}/power", POWER_SCHEMA, DAY, DAY)
    some = read_days(spark, f"{lake}/power", POWER_SCHEMA, DAY, dt.date(2024, 1, 6))
    dated = read_days(spark, f"{lake}/power", POWER_SCHEMA)
    assert (one.count(), some.count(), dated.count()) == (3, 4, 5)
    for frame in (one, some):
        text = plan(frame)
        partition_filters = [x for x in text.splitlines() if x.startswith("PartitionFilters")]
        assert "day" in partition_filters[0] and "Filter (" not in text


def test_absent_table_is_an_error_and_absent_day_is_empty(spark, lake):
    with pytest.raises(AnalysisException):
        read_days(spark, f"{lake}/nothing", POWER_SCHEMA, DAY, DAY)
    missing = dt.date(2030, 1, 1)
    assert read_days(spark, f"{lake}/power", POWER_SCHEMA, missing, missing).count() == 0


def test_days_present(spark, lake):
    p = read_raw(spark, f"{lake}/power", POWER_SCHEMA)
    w = read_raw(spark, f"{lake}/weather", WEATHER_SCHEMA)
    assert rows(days_with_both(p, w)) == [("2024", "01", "05"), ("2024", "01", "06")]
    assert rows(days_skipped(p, w)) == [
        ("2024", "01", "07", "weather"),
        ("2024", "01", "08", "power"),
    ]
    schemas = [x for x in plan(day_presence(p, w)).splitlines() if x.startswith("ReadSchema")]
    assert schemas and all(x == "ReadSchema: struct<>" for x in schemas)


def test_summaries(spark, lake):
    tenth = (dt.datetime(2024, 1, 5, 10), -3.0, 3.0, 15.0, 0.5, 2024, "01", "05")
    sixth = (dt.datetime(2024, 1, 6, 10), None, 3.0, 30.0, None, 2024, "01", "06")
    assert rows(daily_summary(spark, lake, dt.date(2024, 1, 6))) == [tenth]
    assert rows(daily_summary(spark, lake, dt.date(2024, 1, 8))) == []
    assert rows(summary_range(spark, lake, DAY, dt.date(2024, 1, 31))) == [tenth, sixth]
    assert rows(summary_range(spark, lake, None, None)) == [tenth, sixth]
    seventh = (dt.datetime(2024, 1, 7, 10), None, 9.0, 90.0, None)
    undated = (None, None, 6.0, 55.0, None)
    assert rows(full_scan_summary(spark, lake)) == sorted(
        [tenth[:5], sixth[:5], seventh, undated], key=repr
    )


def test_summary_reads_only_what_it_needs(spark, lake):
    text = plan(summary_range(spark, lake, DAY, DAY))
    read = [x for x in text.splitlines() if x.startswith("ReadSchema")]
    assert not any("rainfall_type" in x for x in read)
    assert "ReadSchema: struct<>" in read
    assert text.count("PartitionFilters: [") == 3
    assert "LeftSemi" not in text


def test_writing_a_day_again_changes_nothing(spark, lake, folder):
    table = f"{folder}/warehouse"
    for _ in range(2):
        write_daily_summary(spark, lake, table, dt.date(2024, 1, 6))
    write_daily_summary(spark, lake, table, dt.date(2024, 1, 7))
    assert [r[5:] for r in rows(read_summary(spark, table))] == [
        (2024, "01", "05"),
        (2024, "01", "06"),
    ]
    write_daily_summary(spark, lake, table, dt.date(2024, 1, 6), mode="append")
    assert read_summary(spark, table).count() == 3
    write_daily_summary(spark, lake, table, dt.date(2024, 1, 6), mode="overwrite")
    assert read_summary(spark, table).count() == 1
    with pytest.raises(ValueError):
        write_daily_summary(spark, lake, table, dt.date(2024, 1, 6), mode="merge")


def test_a_withdrawn_day_goes(spark, lake, folder):
    table = f"{folder}/warehouse"
    write_range(spark, lake, table, None, None)
    write_range(spark, lake, table, None, None, mode="append")
    weather_table = read_raw(spark, f"{lake}/weather", WEATHER_SCHEMA)
    left = spark.createDataFrame(weather_table.filter("day <> '06'").collect(), weather_table.schema)
    write_days(left, f"{lake}/weather", "overwrite")
    write_range(spark, lake, table, dt.date(2024, 1, 7), dt.date(2024, 1, 31))
    assert {r[7] for r in rows(read_summary(spark, table))} == {"05", "06"}
    write_range(spark, lake, table, DAY, dt.date(2024, 1, 6))
    assert [r[7] for r in rows(read_summary(spark, table))] == ["05"]
    write_range(spark, f"{folder}", table, dt.date(2030, 1, 1), None)
    assert [r[7] for r in rows(read_summary(spark, table))] == ["05"]


def test_only_changed_days_are_written_again(spark, lake, folder):
    table = f"{folder}/warehouse"

    def files():
        return {f: os.path.getmtime(f) for f in glob.glob(f"{table.removeprefix('file:')}/*/*/*/*.parquet")}

    write_range(spark, lake, table, None, None)
    before = files()
    schemas = {"power": POWER_SCHEMA, "weather": WEATHER_SCHEMA}
    since = {feed: last_change(spark, f"{lake}/{feed}", schema) for feed, schema in schemas.items()}
    later = {feed: when + dt.timedelta(microseconds=1) for feed, when in since.items()}
    assert write_changed_days(spark, lake, table, later) == [] and files() == before
    # Days of files of that very time may have got others in the same tick.
    assert write_changed_days(spark, lake, table, since) != []
    assert rows(read_summary(spark, table)) == rows(summary_range(spark, lake, None, None))
    before, since = files(), later
    time.sleep(0.05)
    late = raw(power(spark, ("20240106113000", 99.0, 1.0), ("20240109113000", 1.0, 1.0)))
    write_days(late, f"{lake}/power", "append")
    changed = write_changed_days(spark, lake, table, since)
    assert changed == [dt.date(2024, 1, 6), dt.date(2024, 1, 9)]
    after = files()
    assert {f: t for f, t in before.items() if "day=05" in f} == {f: t for f, t in after.items() if "day=05" in f}
    assert not {f for f in before if "day=06" in f} & set(after)
    assert rows(read_summary(spark, table)) == rows(summary_range(spark, lake, None, None))
    assert write_changed_days(spark, lake, f"{folder}/other", {}) == [dt.date(2024, 1, d) for d in (5, 6, 7, 8, 9)]


def test_year_bounds_are_plain(spark, lake):
    text = plan(read_days(spark, f"{lake}/power", POWER_SCHEMA, DAY, dt.date(2024, 1, 6)))
    assert "(year#" in text and ">= 2024" in text and "<= 2024" in text


def test_a_day_holding_most_rows_is_split(spark, folder):
    """The rebalance gives a hot day several files instead of one task."""
    wide = F.concat(*[F.sha2(F.concat("id", F.lit(str(i))), 512) for i in range(6)])
    frame = spark.range(0, 40000, 1, 8).select(
        wide.alias("text"),
        F.lit("2024").alias("year"),
        F.lit("01").alias("month"),
        F.when(F.col("id") < 39000, "05").otherwise("06").alias("day"),
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2MB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1MB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        write_days(frame, f"{folder}/hot")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert spark.read.parquet(f"{folder}/hot").count() == 40000
    assert len(glob.glob(f"{folder}/hot/year=2024/month=01/day=05/*.parquet")) > 2
    assert len(glob.glob(f"{folder}/hot/year=2024/month=01/day=06/*.parquet")) == 1
