"""Raise an alert for every power reading with too little reserve.

spark-submit --packages <kafka connector> --py-files tidemark.zip tidemark/jobs/monitor.py --help
"""

import argparse

from pyspark.sql import SparkSession

from tidemark.operators import RESERVE_THRESHOLD_MW
from tidemark.sources import kafka_messages
from tidemark.streaming import run_until_any_ends, start_monitor


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--topic", required=True)
    parser.add_argument("--threshold", type=float, default=RESERVE_THRESHOLD_MW)
    parser.add_argument("--alert-topic", help="send alerts here instead of the console")
    parser.add_argument("--alert-table", help="append alerts to this Parquet folder instead")
    parser.add_argument("--checkpoint", help="needed with a topic or table")
    parser.add_argument("--every", help="trigger interval, such as '1 minute'")
    parser.add_argument("--max-offsets", type=int, help="messages per batch")
    parser.add_argument("--min-partitions", type=int, help="tasks per batch, at least")
    parser.add_argument("--accept-data-loss", action="store_true")
    args = parser.parse_args(argv)
    if (args.alert_topic or args.alert_table) and not args.checkpoint:
        parser.error("a topic or table needs --checkpoint")
    return args


def sink(args: argparse.Namespace) -> tuple[str, dict[str, str]]:
    if args.alert_topic:
        return "kafka", {"kafka.bootstrap.servers": args.servers, "topic": args.alert_topic}
    if args.alert_table:
        return "parquet", {"path": args.alert_table}
    return "console", {}


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("tidemark-monitor").getOrCreate()
    messages = kafka_messages(
        spark,
        args.servers,
        args.topic,
        fail_on_data_loss=False if args.accept_data_loss else None,
        max_offsets_per_trigger=args.max_offsets,
        min_partitions=args.min_partitions,
    )
    name, options = sink(args)
    trigger = {"processingTime": args.every} if args.every else None
    query = start_monitor(messages, args.threshold, name, options, args.checkpoint, trigger)
    run_until_any_ends(spark, [query])


if __name__ == "__main__":
    main()
