"""Helpers the tests share."""

import contextlib
import io
import math

from pyspark.sql import DataFrame


def rows(frame: DataFrame) -> list[tuple]:
    """All rows as tuples in a stable order; NaN shown as text so that it compares."""
    return sorted((_plain(r) for r in frame.collect()), key=repr)


def _plain(row) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row)


def plan(frame: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()


def power(spark, *readings, id_column=False):
    schema = "base_datetime string, current_demand_mw float, reserve_power_mw float"
    return spark.createDataFrame(list(readings), schema + (", id long" if id_column else ""))


def weather(spark, *readings, id_column=False):
    schema = "base_datetime string, rainfall_type int, rainfall_mm float, temperature_c float"
    return spark.createDataFrame(list(readings), schema + (", id long" if id_column else ""))


def messages(spark, *texts):
    encoded = [(None if t is None else bytearray(t.encode()),) for t in texts]
    return spark.createDataFrame(encoded, "value binary")
