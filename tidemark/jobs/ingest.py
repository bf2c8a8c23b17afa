"""Stream both topics into the raw tables until interrupted or one query ends.

spark-submit --packages <kafka connector> --py-files tidemark.zip tidemark/jobs/ingest.py --help
"""

import argparse

from pyspark.sql import SparkSession

from tidemark.schemas import POWER_SCHEMA, WEATHER_SCHEMA
from tidemark.sources import kafka_messages
from tidemark.streaming import run_until_any_ends, start_landing


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--power-topic", required=True)
    parser.add_argument("--weather-topic", required=True)
    parser.add_argument("--lake", required=True, help="root of the raw tables")
    parser.add_argument("--checkpoints", required=True, help="root of the checkpoints")
    parser.add_argument("--starting-offsets", default="earliest")
    parser.add_argument("--every", help="trigger interval, such as '10 minutes'")
    parser.add_argument("--max-offsets", type=int, help="messages per batch and topic")
    parser.add_argument("--min-partitions", type=int, help="tasks per batch, at least")
    parser.add_argument(
        "--gather-days", action="store_true", help="for a backlog that is in no order of time"
    )
    parser.add_argument(
        "--quarantine", help="root of tables for messages that do not fit, instead of rows of NULLs"
    )
    parser.add_argument(
        "--log", help="root of the logs of days that batches touched (default: log below the lake)"
    )
    parser.add_argument("--accept-data-loss", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("tidemark-ingest").getOrCreate()
    queries = []
    for feed, topic, schema in (
        ("power", args.power_topic, POWER_SCHEMA),
        ("weather", args.weather_topic, WEATHER_SCHEMA),
    ):
        messages = kafka_messages(
            spark,
            args.servers,
            topic,
            starting_offsets=args.starting_offsets,
            fail_on_data_loss=False if args.accept_data_loss else None,
            max_offsets_per_trigger=args.max_offsets,
            min_partitions=args.min_partitions,
        )
        queries.append(
            start_landing(
                messages,
                schema,
                path=f"{args.lake}/{feed}",
                checkpoint=f"{args.checkpoints}/{feed}",
                log=f"{args.log or f'{args.lake}/log'}/{feed}",
                aside=f"{args.quarantine}/{feed}" if args.quarantine else None,
                trigger={"processingTime": args.every} if args.every else None,
                name=f"ingest-{feed}",
                gather_days=args.gather_days,
            )
        )
    run_until_any_ends(spark, queries)


if __name__ == "__main__":
    main()
