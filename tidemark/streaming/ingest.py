"""Stream messages into a raw table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.timekeys import date_parts
from tidemark.schemas import DAY_COLUMNS
from tidemark.sources.wire import CORRUPT, decode, decode_with_corrupt, quarantine_split


def land(messages: DataFrame, message: StructType, fitting_only: bool = False) -> DataFrame:
    """Rows of the raw table: decoded readings with their day columns.

    ``fitting_only`` leaves out messages that do not fit the schema as a whole.
    """
    if fitting_only:
        readings, _ = quarantine_split(decode_with_corrupt(messages, message))
    else:
        readings = decode(messages, message)
    return readings.withColumns(date_parts(F.col("base_datetime")))


def start_quarantine(
    messages: DataFrame,
    message: StructType,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append the texts of messages that do not fit the schema to a table of one column.

    With ``start_ingest(..., fitting_only=True)`` over the same messages every
    message goes to exactly one of the two tables.
    """
    _, set_aside = quarantine_split(decode_with_corrupt(messages, message))
    rows = set_aside.withColumnRenamed(CORRUPT, "text")
    return _appended(rows.writeStream.format("parquet"), path, checkpoint, trigger, name)


def start_ingest(
    messages: DataFrame,
    message: StructType,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    gather_days: bool = False,
    fitting_only: bool = False,
) -> StreamingQuery:
    """Append a stream of messages to a raw table, each exactly once.

    Restarted with its checkpoint the query goes on where it stopped. Late rows
    go to their own day. There is no state.

    Messages mostly arrive in order of time, so a task holds few days; it writes
    a file for each, without a shuffle, and a ``processingTime`` trigger of
    minutes keeps the files large. A backlog in no order would make tasks times
    days of them: ``gather_days`` then brings the rows of a day together first,
    and splits a day that holds far more than others. ``fitting_only`` leaves
    messages that do not fit to ``start_quarantine``.
    """
    rows = land(messages, message, fitting_only)
    if gather_days:
        rows = rows.hint("rebalance", *DAY_COLUMNS)
    writer = rows.writeStream.format("parquet").partitionBy(*DAY_COLUMNS)
    return _appended(writer, path, checkpoint, trigger, name)


def _appended(
    writer: DataStreamWriter, path: str, checkpoint: str, trigger: dict | None, name: str | None
) -> StreamingQuery:
    writer = (
        writer.outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()
