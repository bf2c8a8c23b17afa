"""Date-partitioned Parquet tables: year=/month=/day= below one root.

Tables are read at the root with a declared schema and a filter on the
partition columns. Reading the folder of a day instead would lose those
columns and, below a streaming sink, see files of batches never committed.
"""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import DAY_COLUMNS, SUMMARY_SCHEMA, raw_schema
from tidemark.sources.staged import read_committed, settle, stage_days


def within_days(start: dt.date | None, end: dt.date | None) -> Column:
    """Predicate on the partition columns; both ends belong to the range."""
    date = F.try_to_date(F.concat(*DAY_COLUMNS), "yyyyMMdd")
    if start is not None and start == end:
        year, month, day = start.strftime("%Y %m %d").split()
        return (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
    bounds = date.isNotNull()
    # The plain bounds on the year, zero-padded text, also serve a metastore.
    if start is not None:
        bounds = bounds & (F.col("year") >= start.strftime("%Y")) & (date >= F.lit(start))
    if end is not None:
        bounds = bounds & (F.col("year") <= end.strftime("%Y")) & (date <= F.lit(end))
    return bounds


def within(start: dt.date | None, end: dt.date | None) -> Callable[[dt.date], bool]:
    """Whether a day belongs to the range, both ends included."""
    return lambda day: (start is None or day >= start) and (end is None or day <= end)


# Below its days a table landed with a log has a folder for each batch.
BATCH = "batch"
LOG_SCHEMA = "year string, month string, day string, n long, batch long"
STATE_SCHEMA = "feed string, batch long"


def read_raw(spark: SparkSession, root: str, message: StructType) -> DataFrame:
    """A raw table as a whole, undated rows included."""
    schema = raw_schema(message)
    found = spark.read.schema(schema).parquet(root)
    return found.select(*schema.names) if BATCH in found.columns else found


def read_set_aside(spark: SparkSession, path: str) -> DataFrame:
    """The texts of messages that landing has set aside."""
    return spark.read.schema("text string").parquet(path).select("text")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at the path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def batch_log(log: str, number: int) -> str:
    """Where a batch logs the days it touched."""
    return f"{log}/{BATCH}={number}"


def last_batch(spark: SparkSession, log: str) -> int:
    """The last batch that the log of a raw table has; -1 if it has none."""
    if not exists(spark, log):
        return -1
    found = spark.read.schema(LOG_SCHEMA).parquet(log).agg(F.max(BATCH)).first()[0]
    return -1 if found is None else found


def days_touched(spark: SparkSession, log: str, after: int, upto: int) -> set[tuple]:
    """The days, as their column values, that batches after one and up to another have touched; at
    most a row per day comes to the driver."""
    if not exists(spark, log):
        return set()
    entries = spark.read.schema(LOG_SCHEMA).parquet(log).filter(F.col(BATCH).between(after + 1, upto))
    return {tuple(row) for row in entries.select(*DAY_COLUMNS).distinct().dropna().collect()}


def read_state(spark: SparkSession, state: str) -> dict[str, int]:
    """For each feed the last batch that has been taken over."""
    if not exists(spark, state):
        return {}
    found = spark.read.schema(STATE_SCHEMA).parquet(state).groupBy("feed").agg(F.max(BATCH).alias(BATCH))
    return {row["feed"]: row[BATCH] for row in found.collect()}


def append_state(spark: SparkSession, state: str, batches: dict[str, int]) -> None:
    """Remember the last batch taken over of each feed."""
    spark.createDataFrame(list(batches.items()), STATE_SCHEMA).coalesce(1).write.mode("append").parquet(state)


def read_days(
    spark: SparkSession,
    root: str,
    message: StructType,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Days of a raw table; only their folders are read."""
    return read_raw(spark, root, message).where(within_days(start, end))


def read_summary(spark: SparkSession, root: str) -> DataFrame:
    """The hourly summary table, as the last range written to it left or is to leave it."""
    return read_committed(spark, root, SUMMARY_SCHEMA)


def days_since(spark: SparkSession, root: str, message: StructType, since: dt.datetime) -> list[tuple]:
    """The days of a raw table, as their column values, that got files at a point in time or after.

    Times are those the store gives files, which may be whole seconds, so files of
    the very time count, too; no data column is read. At most one row per day comes
    to the driver. Tables landed with a log have an exact answer, ``days_touched``.
    """
    changed = F.col("_metadata.file_modification_time") >= F.lit(since)
    days = spark.read.schema(raw_schema(message)).parquet(root).filter(changed).select(*DAY_COLUMNS).distinct()
    return sorted(tuple(r) for r in days.dropna().collect())


def last_change(spark: SparkSession, root: str, message: StructType) -> dt.datetime | None:
    """When the newest file of a raw table was written; None if it has none."""
    newest = F.max("_metadata.file_modification_time").alias("newest")
    return spark.read.schema(raw_schema(message)).parquet(root).agg(newest).first()["newest"]


def _date(parts: tuple[str, ...]) -> dt.date | None:
    """The day that folder names stand for, if they do."""
    try:
        return dt.date(*map(int, parts))
    except ValueError:
        return None


def write_days(
    frame: DataFrame,
    root: str,
    mode: str = "replace",
    stands_for: Callable[[dt.date], bool] | None = None,
) -> None:
    """Write a frame that has the day columns.

    ``replace`` overwrites exactly the days the frame holds, so writing a day
    again changes nothing; the frame must hold such days whole. With
    ``stands_for`` the frame is also all there is of the days it is true of:
    those of them that the table holds and the frame doesn't are removed, and
    ``read_summary`` sees all of it or nothing, also if the writer fails on the way.
    ``append`` adds rows, ``overwrite`` replaces the table.

    The rebalance gathers each day into few files and splits a day that holds
    far more rows than others, which hashing on the day would send to one task.
    """
    spark = frame.sparkSession
    if mode == "replace" and stands_for:
        stage_days(frame, root, lambda parts: (day := _date(parts)) is not None and stands_for(day))
        settle(spark, root)
        return
    writer = frame.hint("rebalance", *DAY_COLUMNS).write.partitionBy(*DAY_COLUMNS)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "append":
        writer = writer.mode("append")
    elif mode == "overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        raise ValueError(f"unknown mode: {mode}")
    settle(spark, root)
    writer.parquet(root)
