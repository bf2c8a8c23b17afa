"""Text of the message sent when a run fails."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The message, and the word for what is missing.
FAILURE_TEMPLATE = """
    :red_circle: **Task Failed** :red_circle:
    *DAG*: %s
    *Task*: %s
    *Date*: %s
    *Error*: %s
    """
MISSING = "None"


def failure_message(job: Column, task: Column, date: Column, error: Column) -> Column:
    """One message per row; a missing field shows as the word None."""
    fields = [F.coalesce(c.cast("string"), F.lit(MISSING)) for c in (job, task, date, error)]
    return F.format_string(FAILURE_TEMPLATE, *fields)
