import glob
import json

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from helpers import power, rows
from tidemark.schemas import POWER_SCHEMA, WEATHER_SCHEMA
from tidemark.sources import encode, file_messages, kafka_messages, read_days, read_raw
from tidemark.sources.messages import kafka_options
from tidemark.streaming import (
    run_until_any_ends,
    start_ingest,
    start_monitor,
    start_quarantine,
)

ONCE = {"availableNow": True}
FIRST = '{"base_datetime":"20240105100000","current_demand_mw":1.0,"reserve_power_mw":5400.0}'
SECOND = '{"base_datetime":"20240106100000","current_demand_mw":2.0,"reserve_power_mw":5600.0}'
DAMAGED = "not json"


def arrive(spark, folder, *texts):
    frame = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
    frame.write.mode("append").json(f"{folder}/wire")


def ingest(spark, folder):
    messages = file_messages(spark, f"{folder}/wire")
    query = start_ingest(
        messages, POWER_SCHEMA, f"{folder}/raw", f"{folder}/checkpoint", ONCE, name="ingest"
    )
    query.awaitTermination()
    return read_raw(spark, f"{folder}/raw", POWER_SCHEMA)


def test_ingest_restart_and_growth(spark, folder):
    arrive(spark, folder, FIRST, SECOND, DAMAGED)
    landed = [
        ("20240105100000", 1.0, 5400.0, "2024", "01", "05"),
        ("20240106100000", 2.0, 5600.0, "2024", "01", "06"),
        (None,) * 6,
    ]
    assert rows(ingest(spark, folder)) == sorted(landed, key=repr)
    assert rows(ingest(spark, folder)) == sorted(landed, key=repr)
    # A late reading, redelivered: lands in its own day, next to the first.
    arrive(spark, folder, FIRST)
    assert rows(ingest(spark, folder)) == sorted([*landed, landed[0]], key=repr)


def test_quarantine_and_readings_share_all_messages(spark, folder):
    wrong = FIRST.replace("1.0", '"x"')
    arrive(spark, folder, FIRST, DAMAGED, wrong, f"[{FIRST}]", "", SECOND)
    messages = file_messages(spark, f"{folder}/wire")
    for _ in range(2):
        start_ingest(
            messages, POWER_SCHEMA, f"{folder}/raw", f"{folder}/a", ONCE, fitting_only=True
        ).awaitTermination()
        start_quarantine(
            messages, POWER_SCHEMA, f"{folder}/aside", f"{folder}/b", ONCE
        ).awaitTermination()
    readings = rows(read_raw(spark, f"{folder}/raw", POWER_SCHEMA).select(POWER_SCHEMA.names))
    aside = [r.text for r in spark.read.parquet(f"{folder}/aside").collect()]
    assert sorted(aside) == sorted([DAMAGED, wrong, f"[{FIRST}]"])
    landed = [("20240105100000", 1.0, 5400.0), ("20240106100000", 2.0, 5600.0), (None,) * 3]
    assert readings == sorted(landed, key=repr)


def test_files_of_uncommitted_batches_are_not_read(spark, folder):
    arrive(spark, folder, FIRST)
    ingest(spark, folder)
    stray = spark.createDataFrame([("x", 1.0, 1.0)], POWER_SCHEMA)
    stray.write.mode("append").parquet(f"{folder}/raw/year=2024/month=01/day=05")
    assert read_raw(spark, f"{folder}/raw", POWER_SCHEMA).count() == 1
    assert read_days(spark, f"{folder}/raw", POWER_SCHEMA).count() == 1


def test_ingest_plan_is_map_only(spark, folder):
    arrive(spark, folder, FIRST)
    messages = file_messages(spark, f"{folder}/wire", max_files_per_trigger=1)
    query = start_ingest(messages, POWER_SCHEMA, f"{folder}/raw", f"{folder}/checkpoint", ONCE)
    query.awaitTermination()
    text = query._jsq.explainInternal(False)
    assert "Exchange" not in text and "Python" not in text and "StateStore" not in text


@pytest.mark.parametrize("gather", [False, True])
def test_a_backlog_in_no_order_is_gathered_by_day_on_request(spark, folder, gather):
    day = F.lpad((F.col("id") % 3 + 1).cast("string"), 2, "0")
    text = F.format_string(
        '{"base_datetime":"202401%s100000","current_demand_mw":%d,"reserve_power_mw":1}', day, "id"
    )
    spark.range(0, 600, 1, 6).select(text.alias("value")).write.json(f"{folder}/wire")
    start_ingest(
        file_messages(spark, f"{folder}/wire").repartition(6), POWER_SCHEMA, f"{folder}/raw",
        f"{folder}/checkpoint", ONCE, gather_days=gather,
    ).awaitTermination()
    table = read_raw(spark, f"{folder}/raw", POWER_SCHEMA)
    assert rows(table.groupBy("day").count()) == [("01", 200), ("02", 200), ("03", 200)]
    files = len(glob.glob(f"{folder}/raw/*/*/*/*.parquet"))
    assert files == 3 if gather else files > 3


def test_a_hot_day_of_a_backlog_is_split(spark, folder):
    wide = F.concat(*[F.sha2(F.concat("id", F.lit(str(i))), 512) for i in range(6)])
    schema = StructType([StructField("base_datetime", StringType())])
    text = F.format_string('{"base_datetime":"20240105%s"}', wide)
    spark.range(0, 30000, 1, 8).select(text.alias("value")).write.json(f"{folder}/wire")
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2MB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1MB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        start_ingest(
            file_messages(spark, f"{folder}/wire"), schema, f"{folder}/raw",
            f"{folder}/checkpoint", ONCE, gather_days=True,
        ).awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert read_raw(spark, f"{folder}/raw", schema).count() == 30000
    assert len(glob.glob(f"{folder}/raw/*/*/*/*.parquet")) > 2


def test_monitor_sends_alerts_only(spark, folder):
    arrive(spark, folder, FIRST, SECOND, DAMAGED)
    query = start_monitor(
        file_messages(spark, f"{folder}/wire"), sink="memory", name="alerts", trigger=ONCE
    )
    query.awaitTermination()
    assert rows(spark.table("alerts")) == [("20240105100000", 1.0, 5400.0)]


def test_monitor_threshold_and_table_sink(spark, folder):
    arrive(spark, folder, FIRST, SECOND)
    start_monitor(
        file_messages(spark, f"{folder}/wire"), threshold=9000, sink="parquet",
        options={"path": f"{folder}/alerts"}, checkpoint=f"{folder}/checkpoint", trigger=ONCE,
    ).awaitTermination()
    assert spark.read.schema(POWER_SCHEMA).parquet(f"{folder}/alerts").count() == 2


def test_monitor_shows_alerts_on_the_console_by_default(spark, folder):
    arrive(spark, folder, FIRST, SECOND)
    query = start_monitor(file_messages(spark, f"{folder}/wire"), trigger=ONCE)
    query.awaitTermination()
    assert any("Console" in p["sink"]["description"] for p in query.recentProgress)


def test_when_one_query_ends_the_other_is_stopped(spark, folder):
    arrive(spark, folder, FIRST)
    messages = file_messages(spark, f"{folder}/wire")
    endless = start_ingest(messages, POWER_SCHEMA, f"{folder}/a", f"{folder}/ca")
    ending = start_ingest(messages, POWER_SCHEMA, f"{folder}/b", f"{folder}/cb", ONCE)
    run_until_any_ends(spark, [endless, ending])
    assert not endless.isActive and not ending.isActive
    assert read_raw(spark, f"{folder}/b", POWER_SCHEMA).count() == 1


def test_the_error_of_a_failed_query_is_raised(spark, folder):
    arrive(spark, folder, FIRST)
    messages = file_messages(spark, f"{folder}/wire")
    broken = messages.select(F.raise_error(F.lit("broken")).cast("binary").alias("value"))
    healthy = start_ingest(messages, WEATHER_SCHEMA, f"{folder}/a", f"{folder}/ca")
    failing = start_ingest(broken, POWER_SCHEMA, f"{folder}/b", f"{folder}/cb")
    with pytest.raises(StreamingQueryException):
        run_until_any_ends(spark, [healthy, failing])
    assert not healthy.isActive


def test_kafka_options():
    assert kafka_options("host:9092", "power") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "power",
    }
    assert kafka_options("h", "t", "earliest", False, 1000, 64) == {
        "kafka.bootstrap.servers": "h",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }


def test_kafka_without_its_jar_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "host:9092", "power", starting_offsets="earliest")


def test_encoded_stream_keeps_the_envelope(spark, folder):
    power(spark, ("20240105100000", 1.0, 2.0)).write.parquet(f"{folder}/feed")
    stream = spark.readStream.schema(POWER_SCHEMA).parquet(f"{folder}/feed")
    query = encode(stream).writeStream.format("memory").queryName("wire").trigger(**ONCE).start()
    query.awaitTermination()
    assert json.loads(bytes(spark.table("wire").first().value))["base_datetime"] == "20240105100000"
