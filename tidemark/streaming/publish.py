"""Turn a stream of raw responses into messages."""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sources.responses import accepted, rejected
from tidemark.sources.wire import encode


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Sends each batch to a folder of its own, so a batch that is repeated replaces itself."""

    def send(messages: DataFrame, batch: int) -> None:
        messages.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return send


def start_publish(
    responses: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    schema: StructType,
    send: Callable[[DataFrame, int], None],
    checkpoint: str,
    key: Column | None = None,
    rejects: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    order: list[str] | None = None,
) -> StreamingQuery:
    """Send the reading of each new response, and set rejected responses aside whole.

    Restarted with its checkpoint the query goes on where it stopped, so nothing
    is sent again; only a batch that failed halfway is repeated, as a whole. A
    response is parsed once. ``rejects`` is a folder with one folder per batch.
    With ``order`` a batch's messages of a key are sent in that order of the
    readings' columns; batches follow one another.
    """

    def publish_batch(batch: DataFrame, number: int) -> None:
        parsed = parse(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            send(encode(accepted(parsed), schema.names, key, order), number)
            if rejects:
                kept = rejected(parsed, "fetched_at")
                kept.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        finally:
            parsed.unpersist()

    writer = responses.writeStream.foreachBatch(publish_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()
