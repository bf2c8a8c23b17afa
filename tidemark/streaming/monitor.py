"""Raise alerts on a stream of power messages."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.alerts import RESERVE_THRESHOLD_MW, reserve_alerts
from tidemark.schemas import POWER_SCHEMA
from tidemark.sources.wire import decode_once, encode


def start_monitor(
    messages: DataFrame,
    threshold: float = RESERVE_THRESHOLD_MW,
    sink: str = "console",
    options: dict[str, str] | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Send readings below the threshold to a sink as they come.

    The console is for trying out, since it brings rows to the driver; a table
    (``parquet`` with a path) or a topic (``kafka``) takes any number. Without
    a checkpoint the query forgets its place when it ends.
    """
    alerts = reserve_alerts(decode_once(messages, POWER_SCHEMA), threshold)
    rows = encode(alerts) if sink == "kafka" else alerts
    writer = rows.writeStream.outputMode("append").format(sink).options(**(options or {}))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()
