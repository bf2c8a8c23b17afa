"""Summarise one day, or every day of a range, into the warehouse table.

spark-submit --py-files tidemark.zip tidemark/jobs/summarise.py --help
"""

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.operators import days_skipped
from tidemark.plans import failure_messages, read_run_log, run_range, write_range, write_touched_days
from tidemark.plans.runs import DAYS_PER_STEP
from tidemark.schemas import POWER_SCHEMA, WEATHER_SCHEMA
from tidemark.sources import read_days


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--lake", required=True, help="root of the raw tables")
    parser.add_argument("--warehouse", required=True, help="root of the summary table")
    parser.add_argument(
        "--run-date",
        type=dt.date.fromisoformat,
        help="summarise the day before this one (default: today)",
    )
    parser.add_argument("--start", type=dt.date.fromisoformat, help="first day of a range")
    parser.add_argument("--end", type=dt.date.fromisoformat, help="last day of a range")
    parser.add_argument("--time-zone", required=True, help="zone of the readings' wall clock")
    parser.add_argument("--mode", choices=["replace", "append", "overwrite"], default="replace")
    parser.add_argument(
        "--without-weather", action="store_true", help="keep days that lack weather"
    )
    parser.add_argument(
        "--changed", action="store_true", help="summarise the days touched since the last such run"
    )
    parser.add_argument("--log", help="root of the logs that ingest writes (default: log below the lake)")
    parser.add_argument("--state", help="with --changed: folder that remembers what has been summarised")
    parser.add_argument("--run-log", help="log every attempt here, and try a step that fails once more")
    parser.add_argument("--run", help="name of the run; given again, finished days are left alone")
    parser.add_argument("--days-per-step", type=int, default=DAYS_PER_STEP, help="days written together")
    args = parser.parse_args(argv)
    if args.changed and (not args.state or args.start or args.run_date or args.run_log):
        parser.error("--changed needs --state, and takes neither dates nor a run log")
    if args.run and not args.run_log:
        parser.error("--run needs --run-log")
    if args.run_log and args.mode != "replace":
        parser.error("with a run log days are replaced")
    if bool(args.start) != bool(args.end) or (args.start and args.run_date):
        parser.error("give --run-date, or both --start and --end")
    if args.mode == "overwrite" and not args.start:
        parser.error("overwrite replaces the whole table: give --start and --end")
    return args


def days(args: argparse.Namespace) -> tuple[dt.date, dt.date]:
    if args.start:
        return args.start, args.end
    day = (args.run_date or dt.date.today()) - dt.timedelta(days=1)
    return day, day


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    start, end = days(args)
    spark = SparkSession.builder.appName("tidemark-summarise").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    both = not args.without_weather
    if args.changed:
        log = args.log or f"{args.lake}/log"
        write_touched_days(spark, args.lake, args.warehouse, log, args.state, require_both=both)
        return
    if args.run_log:
        try:
            run_range(
                spark, args.lake, args.warehouse, start, end, args.run_log, args.run,
                days_per_step=args.days_per_step, require_both=both,
            )
        except Exception:
            # A row per day of the range at most.
            attempts = read_run_log(spark, args.run_log).filter(F.col("day").between(start, end))
            if args.run:
                attempts = attempts.filter(F.col("run") == args.run)
            last = failure_messages(attempts).groupBy("day").agg(F.max_by("message", "started").alias("message"))
            for row in last.orderBy("day").collect():
                print(row.message)
            raise
    else:
        write_range(spark, args.lake, args.warehouse, start, end, args.mode, require_both=both)
    power = read_days(spark, f"{args.lake}/power", POWER_SCHEMA, start, end)
    weather = read_days(spark, f"{args.lake}/weather", WEATHER_SCHEMA, start, end)
    # One row per day at most.
    for day in days_skipped(power, weather).collect():
        if not (args.without_weather and day.missing_feed == "weather"):
            print(f"{day.year}-{day.month}-{day.day}: no {day.missing_feed} readings")


if __name__ == "__main__":
    main()
