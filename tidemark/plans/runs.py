"""Summary runs that are logged, retried and resumed, day by day."""

import datetime as dt
import re
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.messages import failure_message
from tidemark.plans.summary import write_range
from tidemark.sources.lake import exists

JOB = "daily_summary"
TASK = "write_range"
RETRIES = 1
DAYS_PER_STEP = 32
ERROR_LENGTH = 2000
CONDITION = r"\[([A-Z][A-Z0-9_]+(?:\.[A-Z0-9_]+)*)\]"

# One row per day and attempt; error is what kind of error ended it, NULL if the day was written.
RUN_LOG = """run string, job string, task string, day date, attempt int, started timestamp,
    ended timestamp, error string, detail string"""


def read_run_log(spark: SparkSession, log: str) -> DataFrame:
    """All attempts so far; empty before the first."""
    if exists(spark, log):
        return spark.read.schema(RUN_LOG).parquet(log)
    return spark.createDataFrame([], RUN_LOG)


def days_done(spark: SparkSession, log: str, run: str) -> set[dt.date]:
    """Days that a run has written; the driver gets a row per day."""
    done = read_run_log(spark, log).filter((F.col("run") == run) & F.col("error").isNull())
    return {row["day"] for row in done.select("day").distinct().collect()}


def failure_messages(attempts: DataFrame) -> DataFrame:
    """The rows of a run log that failed, each with the message to send."""
    failed = attempts.filter(F.col("error").isNotNull())
    message = failure_message(F.col("job"), F.col("task"), F.date_format("day", "yyyy-MM-dd"), F.col("error"))
    return failed.withColumn("message", message)


def _kind(error: Exception) -> str:
    """The error's condition if it names one, as Spark's do in brackets, else its class: the same on
    every run."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    named = re.search(CONDITION, str(error))
    return condition or (named and named[1]) or type(error).__name__


def _steps(days: list[dt.date], size: int) -> list[list[dt.date]]:
    """Runs of days that follow one another, of bounded length."""
    steps: list[list[dt.date]] = []
    for day in days:
        if steps and len(steps[-1]) < size and day - steps[-1][-1] == dt.timedelta(days=1):
            steps[-1].append(day)
        else:
            steps.append([day])
    return steps


def run_range(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    start: dt.date,
    end: dt.date,
    log: str,
    run: str | None = None,
    retries: int = RETRIES,
    days_per_step: int = DAYS_PER_STEP,
    write: Callable[..., None] = write_range,
    **options,
) -> list[dt.date]:
    """Summarise the days from start to end into the warehouse table, a step of days at a time, and
    log every attempt; the days written now.

    A step that fails is tried again, ``retries`` times. What still fails doesn't
    keep the other steps from being written; its error is raised in the end. Given
    the name of an earlier ``run`` only the days that run has not written are taken,
    so a run goes on where it stopped and leaves finished days alone. A step's days
    are replaced together by one job and written again whole, so a step that failed
    halfway does no harm. The log is appended to, a small file for an attempt.
    """
    run = run or uuid.uuid4().hex
    done = days_done(spark, log, run)
    days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    written, failed = [], None
    for step in _steps([day for day in days if day not in done], days_per_step):
        for attempt in range(1, retries + 2):
            began, error = dt.datetime.now(), None
            try:
                write(spark, lake, warehouse, step[0], step[-1], **options)
            except Exception as found:  # any error is the step's, and is raised in the end
                error = found
            ended = dt.datetime.now()
            told = (None, None) if error is None else (_kind(error), str(error)[:ERROR_LENGTH])
            rows = [(run, JOB, TASK, day, attempt, began, ended, *told) for day in step]
            spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(log)
            if error is None:
                written += step
                break
            failed = failed if attempt <= retries else failed or error
    if failed is not None:
        raise failed
    return written
