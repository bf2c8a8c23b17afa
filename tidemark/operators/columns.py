"""Column plumbing."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(frame: DataFrame, columns: dict[str, Column], *keep: str) -> DataFrame:
    """Select ``keep`` and the given columns, each evaluated once per row.

    A filter on a plain projection is pushed below it, which copies the
    column's expression into the filter and parses a text a second time for
    each row that passes. It is not pushed below a generator.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select(*keep, F.inline(F.array(row)))
