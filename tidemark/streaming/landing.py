"""Land a stream of messages with one read: readings, what is set aside, and a log of days."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.timekeys import date_parts
from tidemark.schemas import DAY_COLUMNS
from tidemark.sources.lake import BATCH, batch_log
from tidemark.sources.wire import CORRUPT, decode, decode_with_corrupt, quarantine_split


def start_landing(
    messages: DataFrame,
    message: StructType,
    path: str,
    checkpoint: str,
    log: str,
    aside: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    gather_days: bool = False,
) -> StreamingQuery:
    """Append a stream of messages to a raw table, and to ``log`` the days that each batch touched.

    With ``aside`` messages that don't fit the schema as a whole go there as texts,
    and the rest to the table, from the same read, so that each goes to exactly one of the two.

    A batch owns a folder in each day, one in ``aside`` and one in the log. One that
    is repeated after a failure replaces them, so nothing is there twice; its entry
    in the log comes last, so what the log names is there whole. ``gather_days`` is
    as for ``start_ingest``.
    """

    def land_batch(batch: DataFrame, number: int) -> None:
        decoded = decode_with_corrupt(batch, message) if aside else decode(batch, message)
        decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            readings, texts = quarantine_split(decoded) if aside else (decoded, None)
            rows = readings.withColumns(date_parts(F.col("base_datetime"))).withColumn(BATCH, F.lit(number))
            if gather_days:
                rows = rows.hint("rebalance", *DAY_COLUMNS)
            writer = rows.write.partitionBy(*DAY_COLUMNS, BATCH).mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").parquet(path)
            if texts is not None:
                texts.withColumnRenamed(CORRUPT, "text").write.mode("overwrite").parquet(f"{aside}/{BATCH}={number}")
            days = rows.groupBy(*DAY_COLUMNS).agg(F.count("*").alias("n"))
            days.coalesce(1).write.mode("overwrite").parquet(batch_log(log, number))
        finally:
            decoded.unpersist()

    writer = messages.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()
