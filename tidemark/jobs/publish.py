"""Turn new raw responses of a table into messages on a topic, and set the rest aside.

spark-submit --packages <kafka connector> --py-files tidemark.zip tidemark/jobs/publish.py --help
"""

import argparse
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import POWER_SCHEMA, WEATHER_SCHEMA
from tidemark.sources import parse_power, parse_weather, publish
from tidemark.streaming import run_until_any_ends, start_publish

RESPONSES = "fetched_at timestamp, payload string"


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--feed", choices=["power", "weather"], required=True)
    parser.add_argument(
        "--responses", required=True, help="Parquet folder with fetched_at and payload"
    )
    parser.add_argument("--checkpoint", required=True, help="remembers what has been sent")
    parser.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--topic", required=True)
    parser.add_argument("--time-zone", required=True, help="zone of the sources' wall clock")
    parser.add_argument("--key", help="message key; its messages are sent in order of event time")
    parser.add_argument("--rejects", help="set rejected responses aside below this folder")
    parser.add_argument("--every", help="keep running with this trigger interval")
    parser.add_argument("--max-files", type=int, help="new files per batch")
    parser.add_argument(
        "--blank-as-null", action="store_true", help="keep a blank power figure blank, not 0"
    )
    return parser.parse_args(argv)


def parser_of(args: argparse.Namespace):
    """How the feed's responses are parsed, and the schema of its messages."""
    if args.feed == "power":
        return partial(parse_power, blank_as_null=args.blank_as_null), POWER_SCHEMA
    return parse_weather, WEATHER_SCHEMA


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("tidemark-publish").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    parse, schema = parser_of(args)
    reader = spark.readStream.schema(RESPONSES)
    if args.max_files:
        reader = reader.option("maxFilesPerTrigger", args.max_files)
    query = start_publish(
        reader.parquet(args.responses),
        parse,
        schema,
        send=lambda messages, batch: publish(messages, args.servers, args.topic),
        checkpoint=args.checkpoint,
        key=F.lit(args.key) if args.key is not None else None,
        rejects=args.rejects,
        order=["base_datetime"] if args.key is not None else None,
        trigger={"processingTime": args.every} if args.every else {"availableNow": True},
        name=f"publish-{args.feed}",
    )
    run_until_any_ends(spark, [query])


if __name__ == "__main__":
    main()
