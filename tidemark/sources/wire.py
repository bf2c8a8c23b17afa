"""Messages on the wire: one JSON object as UTF-8 bytes in a column ``value``.

The functions work on batch and streaming frames alike.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def decode(messages: DataFrame, schema: StructType) -> DataFrame:
    """Typed readings, one per message, never failing.

    A value that is no JSON object gives a row of NULLs, a field of the wrong
    type only a NULL in that field; unknown fields are ignored.
    """
    record = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(record.alias("data")).select("data.*")


def decode_once(messages: DataFrame, schema: StructType) -> DataFrame:
    """Like ``decode``, for readings about to be filtered.

    A filter on a projection is pushed below it and parses each message again;
    it is not pushed below a generator. Without a filter ``decode`` is faster.
    """
    record = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.inline(F.array(record)))


def decode_with_corrupt(messages: DataFrame, schema: StructType) -> DataFrame:
    """Like ``decode``, with the text of every message that did not fit whole."""
    text = F.col("value").cast("string")
    marked = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    record = F.from_json(text, marked, {"columnNameOfCorruptRecord": CORRUPT})
    return messages.select(F.inline(F.array(record)))


def quarantine_split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings that fitted the schema, and the texts of those that did not.

    Nothing falls between: a missing or empty message, which has no text to
    show, stays among the readings as a row of NULLs.
    """
    fits = F.col(CORRUPT).isNull()
    return decoded.filter(fits).drop(CORRUPT), decoded.filter(~fits).select(CORRUPT)


def encode(
    readings: DataFrame,
    fields: list[str] | None = None,
    key: Column | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Messages for a topic.

    With a key and an ``order``, columns of the readings, all messages of a key come
    from one task and in that order (equal ones by their text), so that a topic,
    which keeps what a task sends of a key in order, has them so. Without it tasks
    send side by side.
    """
    names = fields or readings.columns
    # A field that is present but NULL is written as null, as a reader would
    # see it in the record, rather than left out.
    value = F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).cast("binary")
    columns = [value.alias("value")]
    if key is not None:
        columns.insert(0, key.cast("binary").alias("key"))
    if key is None or not order:
        return readings.select(*columns)
    ranked = readings.select(*columns, F.struct(*order).alias("_order"))
    return ranked.repartition("key").sortWithinPartitions("key", "_order", "value").drop("_order")
