"""Run queries side by side."""

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def run_until_any_ends(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until one of the queries ends, then stop the others.

    The error of a query that failed is raised again; an interrupt stops all.
    """
    try:
        spark.streams.resetTerminated()
        # One that ended before the reset would not wake the wait.
        if all(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    for query in queries:
        if query.exception() is not None:
            raise query.exception()
