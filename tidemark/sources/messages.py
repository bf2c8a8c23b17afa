"""Where message streams come from and go to.

The Kafka connector is an extra jar (spark-submit --packages
org.apache.spark:spark-sql-kafka-0-10_2.13 in the Spark version at hand).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str | None = None,
    fail_on_data_loss: bool | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options; what is left out keeps Spark's default (latest offsets).

    One task reads each topic partition, so a partition that holds much of the
    topic is slow; ``min_partitions`` above their number splits large ones.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting_offsets is not None:
        options["startingOffsets"] = starting_offsets
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream of a topic.

    After a topic was recreated the checkpoint points past its end and the
    query fails; start again with a new checkpoint folder, or set
    ``fail_on_data_loss`` off to accept the gap.
    """
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, **options)).load()


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of a folder of JSON lines, each with the message text as ``value``."""
    reader = spark.readStream.schema(StructType([StructField("value", StringType())]))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path).select(F.col("value").cast("binary").alias("value"))


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Send encoded messages to a topic, at least once."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    messages.write.format("kafka").options(**options).save()
