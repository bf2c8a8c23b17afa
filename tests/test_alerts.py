from pyspark.sql import functions as F

from helpers import power, rows
from tidemark.functions import failure_message
from tidemark.operators import reserve_alerts


def test_threshold_is_strict_and_skips_missing(spark):
    readings = power(
        spark, ("a", 1.0, 5499.75), ("b", 1.0, 5500.0), ("c", 1.0, None),
        ("d", 1.0, float("nan")), ("e", 1.0, 0.0),
    )
    assert [r[0] for r in rows(reserve_alerts(readings))] == ["a", "e"]
    assert [r[0] for r in rows(reserve_alerts(readings, 5499))] == ["e"]


def test_failure_message(spark):
    log = spark.createDataFrame(
        [("daily", "summarise", "2024-01-15", "100% disk"), ("daily", "t", None, None)],
        "job string, task string, day string, error string",
    )
    message = failure_message(F.col("job"), F.col("task"), F.col("day"), F.col("error"))
    assert rows(log.select(message)) == sorted(
        [
            (
                "\n    :red_circle: **Task Failed** :red_circle:\n    *DAG*: daily"
                "\n    *Task*: summarise\n    *Date*: 2024-01-15\n    *Error*: 100% disk\n    ",
            ),
            (
                "\n    :red_circle: **Task Failed** :red_circle:\n    *DAG*: daily"
                "\n    *Task*: t\n    *Date*: None\n    *Error*: None\n    ",
            ),
        ],
        key=repr,
    )
