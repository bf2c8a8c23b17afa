"""The registered queries: (session, folder of tables) -> DataFrame.

Each runs over the whole table ``events``. Times are shown as text and floats
as doubles rounded to four digits, so that results compare across engines.
"""

import contextlib
import datetime as dt
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import functions as fn
from tidemark import operators as ops
from tidemark import plans, sources, streaming
from tidemark.catalog import feeds
from tidemark.catalog.feeds import ID
from tidemark.schemas import (
    DAY_COLUMNS,
    POWER_SCHEMA,
    POWER_TIME_FORMAT,
    WEATHER_SCHEMA,
    WEATHER_TIME_FORMAT,
    with_id,
)
from tidemark.session import new_folder, remove_files, remove_folder

RUN_DATE = dt.date(2024, 1, 16)
RANGE_START, RANGE_END = dt.date(2024, 1, 8), dt.date(2024, 1, 21)
POWER_OUTAGE_DAYS = ["07", "14", "21", "28"]
WEATHER_OUTAGE_DAYS = ["05", "10", "15", "20", "25", "30"]
LATE_DAYS = [5, 6]
BROKEN_DAY, STEP_DAYS = dt.date(2024, 1, 12), 4
TIME_SHOWN = "yyyy-MM-dd HH:mm:ss"

POWER_WITH_ID = with_id(POWER_SCHEMA, ID)
WEATHER_WITH_ID = with_id(WEATHER_SCHEMA, ID)
ONCE = {"availableNow": True}


def shown(frame: DataFrame) -> DataFrame:
    """Timestamps as text; floats, and integers that may be missing, as rounded doubles."""
    columns: list[Column] = []
    for field in frame.schema:
        column, kind = F.col(field.name), field.dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, TIME_SHOWN)
        elif kind in ("float", "double") or field.name == "rainfall_type":
            column = F.round(column.cast("double"), 4)
        columns.append(column.alias(field.name))
    return frame.select(columns)


def _feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    source = feeds.events(spark, sf_dir)
    return feeds.power_feed(source), feeds.weather_feed(source)


# The raw tables last landed from a folder of tables, and the files they came from.
_landed: dict[tuple[str, str], tuple[list[tuple], str]] = {}


def _files(source: DataFrame) -> list[tuple]:
    """Name, length and time of change of each file of a table."""
    listed = []
    context = source.sparkSession.sparkContext
    for name in sorted(source.inputFiles()):
        path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(name))
        status = path.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(path)
        listed.append((name, status.getLen(), status.getModificationTime()))
    return listed


def _lake(spark: SparkSession, sf_dir: str, anew: bool = False) -> str:
    """Root of the raw tables power and weather, landed from the feeds' messages.

    Landed once for the files as they are: after any change of them, or when
    asked to, the tables are landed anew and the earlier ones removed.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    files = _files(feeds.events(spark, sf_dir))
    before = _landed.get(key)
    if before and not anew and before[0] == files and _still_there(spark, before[1]):
        return before[1]
    root = new_folder(spark, "lake")
    power, weather = _feeds(spark, sf_dir)
    power_rows = streaming.land(sources.encode(power), POWER_WITH_ID)
    weather_rows = streaming.land(sources.encode(weather), WEATHER_WITH_ID)
    sources.write_days(power_rows, f"{root}/power")
    sources.write_days(weather_rows, f"{root}/weather")
    _landed[key] = (files, root)
    if before:
        remove_folder(spark, before[1])
    return root


def land_feeds(spark: SparkSession, sf_dir: str) -> None:
    """Land the raw tables that seven queries read, whatever was landed before."""
    _lake(spark, sf_dir, anew=True)


def _still_there(spark: SparkSession, lake: str) -> bool:
    """Whether nobody has cleared the shared folder meanwhile."""
    try:
        for feed, schema in (("power", POWER_SCHEMA), ("weather", WEATHER_SCHEMA)):
            sources.read_raw(spark, f"{lake}/{feed}", schema)
    except AnalysisException:
        return False
    return True


def _with_outages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both raw tables' days, where on some days all rows are one feed's."""
    lake = _lake(spark, sf_dir)
    power = sources.read_raw(spark, f"{lake}/power", POWER_SCHEMA).select(*DAY_COLUMNS)
    weather = sources.read_raw(spark, f"{lake}/weather", WEATHER_SCHEMA).select(*DAY_COLUMNS)
    no_power = F.coalesce(F.col("day").isin(POWER_OUTAGE_DAYS), F.lit(False))
    no_weather = F.coalesce(F.col("day").isin(WEATHER_OUTAGE_DAYS), F.lit(False))
    return (
        power.filter(~no_power).unionByName(weather.filter(no_weather)),
        weather.filter(~no_weather).unionByName(power.filter(no_power)),
    )


# Scans and responses


def day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, day = _lake(spark, sf_dir), RUN_DATE - dt.timedelta(days=1)
    power = sources.read_days(spark, f"{lake}/power", POWER_SCHEMA, day, day)
    weather = sources.read_days(spark, f"{lake}/weather", WEATHER_SCHEMA, day, day)
    both = power.select(F.lit("power").alias("feed"), "base_datetime", *DAY_COLUMNS).unionAll(
        weather.select(F.lit("weather").alias("feed"), "base_datetime", *DAY_COLUMNS)
    )
    return both


def power_from_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = sources.parse_power(feeds.power_responses(feeds.events(spark, sf_dir)))
    return shown(sources.accepted(parsed).drop("fetched_at"))


def weather_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = sources.parse_weather(feeds.weather_responses(feeds.events(spark, sf_dir)))
    return shown(sources.accepted(parsed).drop("fetched_at"))


def weather_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = sources.observation_items(feeds.weather_responses(feeds.events(spark, sf_dir)), ID)
    return shown(sources.pivot_observations(items, ID))


def _all_parsed(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    source = feeds.events(spark, sf_dir)
    power = sources.parse_power(feeds.power_responses(source))
    weather = sources.parse_weather(feeds.weather_responses(source))
    return [power.withColumn("feed", F.lit("power")), weather.withColumn("feed", F.lit("weather"))]


def api_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected responses of both feeds, counted per reason, code and message."""
    power, weather = (sources.reject_report(p, "feed") for p in _all_parsed(spark, sf_dir))
    return power.unionAll(weather)


def rejected_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected response of both feeds with its whole payload."""
    kept = ["feed", ID, "fetched_at"]
    power, weather = (sources.rejected(p, *kept) for p in _all_parsed(spark, sf_dir))
    return shown(power.unionAll(weather).select(*kept, "reject_reason", "payload"))


# Wire


def decode_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.power_messages(feeds.events(spark, sf_dir))
    return shown(sources.decode(messages, POWER_SCHEMA))


def decode_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.weather_messages(feeds.events(spark, sf_dir))
    return shown(sources.decode(messages, WEATHER_SCHEMA))


def encode_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    power, weather = _feeds(spark, sf_dir)
    power_wire = sources.encode(power, POWER_SCHEMA.names, key=F.lit("power"))
    weather_wire = sources.encode(weather, WEATHER_SCHEMA.names, key=F.lit("weather"))
    both = power_wire.unionAll(weather_wire)
    return both.select(F.col("key").cast("string"), F.col("value").cast("string"))


# Columns


def _damaged_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times of both feeds, some cut short, some missing, some not times."""
    source = feeds.with_kind(feeds.events(spark, sf_dir))
    power = F.date_format("ts", POWER_TIME_FORMAT)
    weather = F.date_format("ts", "yyyyMMddHH'00'")
    whole = F.when(F.col("event_type") == "view", weather).otherwise(power)
    time = (
        F.when(F.col("kind") < 5, F.substring(whole, 1, 4))
        .when(F.col("kind") < 10, F.lit(None).cast("string"))
        .when(F.col("kind") < 15, F.concat(F.substring(whole, 1, 4), F.lit("-xx")))
        .otherwise(whole)
    )
    return source.select(ID, "event_type", time.alias("base_datetime"))


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = _damaged_times(spark, sf_dir).drop("event_type")
    return times.withColumns(fn.date_parts(F.col("base_datetime")))


def date_parts_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    power, _ = _feeds(spark, sf_dir)
    time = fn.event_time(F.col("base_datetime"), POWER_TIME_FORMAT)
    times = power.select(ID, time.alias("time"))
    return times.select(ID, *_named(fn.calendar_parts(F.col("time"))))


def hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = _damaged_times(spark, sf_dir)
    power = ops.hour_bucket(times.filter(feeds.IS_POWER), POWER_TIME_FORMAT)
    weather = ops.hour_bucket(times.filter(feeds.IS_WEATHER), WEATHER_TIME_FORMAT)
    return shown(power.unionAll(weather).select(ID, "base_datetime", "hour_timestamp"))


def target_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.events(spark, sf_dir).select(ID, *_named(fn.target_day(F.col("ts"))))


def publish_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.events(spark, sf_dir).select(ID, *_named(fn.publish_slot(F.col("ts"))))


def ts_format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", TIME_SHOWN).alias("formatted")
    formatted = feeds.events(spark, sf_dir).select(ID, text)
    parsed = fn.event_time(F.col("formatted"), TIME_SHOWN)
    return shown(formatted.withColumn("parsed", parsed))


def alert_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure messages over a run log in which every event is a failed run."""
    message = fn.failure_message(
        F.lit("daily_summary"),
        F.col("event_type"),
        F.date_format("ts", "yyyy-MM-dd"),
        F.when(F.col("event_type") == "error", F.col("props")),
    )
    return feeds.events(spark, sf_dir).select(ID, message.alias("message"))


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


# Filters, dedup, join, summary


def reserve_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.power_messages(feeds.events(spark, sf_dir))
    return shown(ops.reserve_alerts(sources.decode_once(messages, POWER_SCHEMA)))


def dedup_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ops.dedup(_feeds(spark, sf_dir)[0], tie_break=ID))


def dedup_power_no_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some readings lack their id; those of one time are alike but for where they stand."""
    power, _ = _feeds(spark, sf_dir)
    lost = F.col(ID) % 3 == 0
    told = power.withColumns(
        {
            "current_demand_mw": F.when(lost, F.lit(60000.0).cast("float")).otherwise(F.col("current_demand_mw")),
            "reserve_power_mw": F.when(lost, F.lit(5000.0).cast("float")).otherwise(F.col("reserve_power_mw")),
            ID: F.when(~lost, F.col(ID)),
        }
    )
    return shown(ops.dedup(told, tie_break=ID))


def dedup_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ops.dedup(_feeds(spark, sf_dir)[1], tie_break=ID))


def dedup_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their texts, one per hour; every third of them comes twice."""
    time = F.date_format("ts", "yyyyMMddHH'00'").alias("base_datetime")
    told = feeds.events(spark, sf_dir).select(time, ID, "event_type", "props", "value")
    return shown(ops.dedup_wide(told.unionAll(told.filter(F.col(ID) % 3 == 0)), tie_break=ID))


def hourly_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    power, weather = _feeds(spark, sf_dir)
    joined = ops.hourly_join(
        ops.dedup(power, tie_break=ID).drop(ID), ops.dedup(weather, tie_break=ID).drop(ID)
    )
    return shown(joined)


def hourly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(flagship(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly summary with its own types."""
    power, weather = _feeds(spark, sf_dir)
    return ops.hourly_summary(power, weather, tie_break=ID)


def temp_demand_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ops.temp_demand_corr(flagship(spark, sf_dir)))


# Days


def days_with_both_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.days_with_both(*_with_outages(spark, sf_dir))


def days_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.days_skipped(*_with_outages(spark, sf_dir))


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(plans.daily_summary(spark, _lake(spark, sf_dir), RUN_DATE, tie_break=ID))


def summary_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    return shown(plans.summary_range(spark, lake, RANGE_START, RANGE_END, tie_break=ID))


def full_scan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(plans.full_scan_summary(spark, _lake(spark, sf_dir), tie_break=ID))


def summary_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day summarised into a table that holds a day no longer there, then one day again."""
    lake, table = _lake(spark, sf_dir), new_folder(spark, "warehouse")
    everything = plans.summary_range(spark, lake, None, None, tie_break=ID)
    withdrawn = {"year": F.lit(2023), "month": F.lit("12"), "day": F.lit("31")}
    sources.write_days(everything.withColumns(withdrawn), table)
    plans.write_range(spark, lake, table, None, None, tie_break=ID)
    plans.write_daily_summary(spark, lake, table, RUN_DATE, tie_break=ID)
    return shown(sources.read_summary(spark, table))


def summary_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of every day, overwritten by a range of days."""
    lake, table = _lake(spark, sf_dir), new_folder(spark, "warehouse")
    plans.write_range(spark, lake, table, None, None, tie_break=ID)
    plans.write_range(spark, lake, table, RANGE_START, RANGE_END, "overwrite", tie_break=ID)
    return shown(sources.read_summary(spark, table))


def summary_seen_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of some days and one that is gone, all without demand, as readers see it before every
    day is written, once that is ordered but nothing moved, and when all is moved."""
    lake, root = _lake(spark, sf_dir), new_folder(spark, "seen")
    table, seen = f"{root}/table", f"{root}/seen"
    some = plans.summary_range(spark, lake, RANGE_START, RANGE_END, tie_break=ID)
    some = some.withColumn("max_demand_mw", F.lit(None).cast("float"))
    gone = {"year": F.lit(2023), "month": F.lit("12"), "day": F.lit("31")}
    for days in (some, some.withColumns(gone)):
        sources.write_days(days, table)

    def look(state: str) -> None:
        rows = sources.read_summary(spark, table).withColumn("state", F.lit(state))
        rows.write.mode("append").parquet(seen)

    look("before")
    sources.stage_days(plans.summary_range(spark, lake, None, None, tie_break=ID), table, lambda day: True)
    look("ordered")
    sources.settle(spark, table)
    look("moved")
    return shown(spark.read.parquet(seen))


# Streams: the tables come as one backlog, in whatever order their files are


def _ingest(
    messages: DataFrame, schema: StructType, path: str, checkpoint: str, gather_days: bool = True
) -> StreamingQuery:
    return streaming.start_ingest(
        messages, schema, path, checkpoint, ONCE, gather_days=gather_days
    )


def _ingested(
    spark: SparkSession,
    messages: DataFrame,
    schema: StructType,
    label: str,
    runs: int = 1,
    gather_days: bool = True,
) -> str:
    """Root of a raw table after streaming all messages into it."""
    path, checkpoint = new_folder(spark, label), new_folder(spark, f"{label}-checkpoint")
    for _ in range(runs):
        _ingest(messages, schema, path, checkpoint, gather_days).awaitTermination()
    return path


def ingest_power_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.power_messages(feeds.events_stream(spark, sf_dir))
    path = _ingested(spark, messages, POWER_SCHEMA, "power")
    return shown(sources.read_raw(spark, path, POWER_SCHEMA))


def ingest_weather_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a shuffle: each task writes the days it holds."""
    messages = feeds.weather_messages(feeds.events_stream(spark, sf_dir))
    path = _ingested(spark, messages, WEATHER_SCHEMA, "weather", gather_days=False)
    return shown(sources.read_raw(spark, path, WEATHER_SCHEMA))


def ingest_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query run again with its checkpoint adds nothing."""
    messages = feeds.power_messages(feeds.events_stream(spark, sf_dir))
    path = _ingested(spark, messages, POWER_SCHEMA, "power", runs=2)
    return shown(sources.read_raw(spark, path, POWER_SCHEMA))


def ingest_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries side by side; rows per feed and day."""
    source = feeds.events_stream(spark, sf_dir)
    root, checkpoint = new_folder(spark, "both"), new_folder(spark, "both-checkpoint")
    parts = [
        ("power", feeds.power_messages(source), POWER_SCHEMA),
        ("weather", feeds.weather_messages(source), WEATHER_SCHEMA),
    ]
    running = [
        _ingest(messages, schema, f"{root}/{feed}", f"{checkpoint}/{feed}")
        for feed, messages, schema in parts
    ]
    for query in running:
        query.awaitTermination()
    rows = None
    for feed, _, schema in parts:
        days = sources.read_raw(spark, f"{root}/{feed}", schema).select(
            F.lit(feed).alias("feed"), *DAY_COLUMNS
        )
        rows = days if rows is None else rows.unionAll(days)
    return rows.groupBy("feed", *DAY_COLUMNS).agg(F.count("*").alias("n"))


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.power_messages(feeds.events_stream(spark, sf_dir))
    path, checkpoint = new_folder(spark, "alerts"), new_folder(spark, "alerts-checkpoint")
    streaming.start_monitor(
        messages, sink="parquet", options={"path": path}, checkpoint=checkpoint, trigger=ONCE
    ).awaitTermination()
    return shown(spark.read.schema(POWER_SCHEMA).parquet(path))


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power messages, read once: readings of those that fit, and the texts of those that don't.
    The query run again adds nothing."""
    root = new_folder(spark, "landing")
    for _ in range(2):
        messages = feeds.power_messages(feeds.events_stream(spark, sf_dir))
        streaming.start_landing(
            messages, POWER_SCHEMA, f"{root}/power", f"{root}/checkpoint", f"{root}/log", f"{root}/aside", ONCE
        ).awaitTermination()
    readings = shown(sources.read_raw(spark, f"{root}/power", POWER_SCHEMA).drop(*DAY_COLUMNS))
    return readings.unionByName(sources.read_set_aside(spark, f"{root}/aside"), True)


def publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw power responses streamed into messages and rejects, twice; the second run adds nothing."""
    raw, out = new_folder(spark, "responses"), new_folder(spark, "published")
    feeds.power_responses(feeds.events(spark, sf_dir)).drop(ID).write.parquet(raw)
    for _ in range(2):
        streaming.start_publish(
            spark.readStream.schema("fetched_at timestamp, payload string").parquet(raw),
            sources.parse_power,
            POWER_SCHEMA,
            streaming.to_folder(f"{out}/messages"),
            f"{out}/checkpoint",
            key=F.lit("power"),
            rejects=f"{out}/rejects",
            trigger=ONCE,
        ).awaitTermination()
    sent = spark.read.schema("key binary, value binary").parquet(f"{out}/messages")
    rejects = spark.read.schema("reject_reason string, payload string").parquet(f"{out}/rejects")
    return sent.select(
        F.lit("message").alias("kind"), F.col("value").cast("string").alias("text")
    ).unionAll(rejects.select("reject_reason", "payload"))


def publish_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power responses sent with a key for each hour of the day: the messages as they stand in the
    parts that were sent, and how many parts of the batch hold the key."""
    raw, out = new_folder(spark, "responses"), new_folder(spark, "ordered")
    feeds.power_responses(feeds.events(spark, sf_dir)).drop(ID).write.parquet(raw)
    streaming.start_publish(
        spark.readStream.schema("fetched_at timestamp, payload string").parquet(raw),
        sources.parse_power,
        POWER_SCHEMA,
        streaming.to_folder(f"{out}/messages"),
        f"{out}/checkpoint",
        key=F.substring("base_datetime", 9, 2),
        order=["base_datetime"],
        trigger=ONCE,
    ).awaitTermination()
    sent = spark.read.schema("key binary, value binary").parquet(f"{out}/messages")
    sent = sent.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("text"),
        F.col("_metadata.file_path").alias("part"),
        F.col("_metadata.row_index").alias("at"),
    )
    parts = sent.groupBy("key").agg(F.count_distinct("part").alias("parts"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("part", "at"))
    return sent.withColumn("place", place).join(parts, "key").select("key", "text", "place", "parts")


def late_day_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days summarised, then those again that late power readings came in for, as the log of landed
    batches tells: first the errors of a few days, then all others."""
    source = feeds.events(spark, sf_dir)
    wire, root = new_folder(spark, "wire"), new_folder(spark, "late")
    checkpoint, table = new_folder(spark, "late-checkpoint"), new_folder(spark, "late-warehouse")

    def arrive(feed: str, readings: DataFrame) -> None:
        sources.encode(readings).write.mode("append").parquet(f"{wire}/{feed}")

    def ingest(feed: str, schema: StructType) -> None:
        messages = spark.readStream.schema("value binary").parquet(f"{wire}/{feed}")
        streaming.start_landing(
            messages, schema, f"{root}/{feed}", f"{checkpoint}/{feed}", f"{root}/log/{feed}", trigger=ONCE, gather_days=True
        ).awaitTermination()

    late = F.coalesce(F.col("event_type") == "error", F.lit(False))
    few = F.coalesce(F.dayofmonth("ts").isin(LATE_DAYS), F.lit(False))
    arrive("weather", feeds.weather_feed(source))
    ingest("weather", WEATHER_WITH_ID)
    for batch in (~late, late & few, late & ~few):
        arrive("power", feeds.power_feed(source.filter(batch)))
        ingest("power", POWER_WITH_ID)
        plans.write_touched_days(spark, root, table, f"{root}/log", f"{root}/state", tie_break=ID)
    return shown(sources.read_summary(spark, table))


# Runs: one with a day that can't be read, and again once it can


def _broken_run(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Lake, warehouse and run log after a run over a range in which what one day holds is no
    Parquet, so that its step fails, twice."""
    root = new_folder(spark, "broken")
    power, weather = _feeds(spark, sf_dir)
    for feed, readings, schema in (("power", power, POWER_WITH_ID), ("weather", weather, WEATHER_WITH_ID)):
        sources.write_days(streaming.land(sources.encode(readings), schema), f"{root}/lake/{feed}")
    year, month, day = BROKEN_DAY.strftime("%Y %m %d").split()
    junk = f"{root}/lake/power/year={year}/month={month}/day={day}"
    spark.createDataFrame([("no Parquet",)], "text string").coalesce(1).write.mode("append").text(junk)
    with contextlib.suppress(PySparkException, Py4JJavaError):
        _run(spark, root)
    return root, junk, f"{root}/runs"


def _run(spark: SparkSession, root: str) -> list[dt.date]:
    return plans.run_range(
        spark, f"{root}/lake", f"{root}/warehouse", RANGE_START, RANGE_END, f"{root}/runs", "backfill",
        days_per_step=STEP_DAYS, tie_break=ID,
    )


def summary_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of days, one step of which fails at first; the run, started again once its day can be
    read, writes that step alone. Each day with how many attempts it took and how many failed."""
    root, junk, log = _broken_run(spark, sf_dir)
    remove_files(spark, junk, ".txt")
    _run(spark, root)
    attempts = plans.read_run_log(spark, log).groupBy(F.date_format("day", "dd").alias("day")).agg(
        F.count("*").alias("attempts"), F.count("error").alias("failures")
    )
    return shown(sources.read_summary(spark, f"{root}/warehouse")).join(attempts, "day")


def failed_run_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message of every attempt that failed, from the log the run has written itself."""
    _, _, log = _broken_run(spark, sf_dir)
    return plans.failure_messages(plans.read_run_log(spark, log)).select("run", "attempt", "message")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        hourly_summary,
        day_scan,
        power_from_xml,
        weather_from_json,
        weather_pivot,
        api_rejects,
        rejected_payloads,
        decode_power,
        decode_weather,
        encode_wire,
        date_parts,
        date_parts_typed,
        hour_bucket,
        target_day,
        publish_slot,
        ts_format_roundtrip,
        alert_message,
        reserve_alerts,
        dedup_power,
        dedup_power_no_id,
        dedup_weather,
        dedup_wide,
        hourly_join,
        temp_demand_corr,
        days_with_both_feeds,
        days_skipped,
        daily_summary,
        summary_range,
        full_scan_summary,
        summary_write_roundtrip,
        summary_overwrite,
        summary_seen_whole,
        ingest_power_lake,
        ingest_weather_lake,
        ingest_restart,
        ingest_both,
        ingest_quarantine,
        publish_stream,
        publish_ordered,
        stream_alerts,
        late_day_rerun,
        summary_resumed,
        failed_run_messages,
    )
}
