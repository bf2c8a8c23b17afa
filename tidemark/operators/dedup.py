"""One reading per event time."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import DAY_COLUMNS

LAST = 2**63 - 1
HASH_BITS = 62


def dedup(
    readings: DataFrame,
    key: str = "base_datetime",
    tie_break: str | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """Keep one whole row per key, the same one on every run.

    The survivor has the lowest ``tie_break`` (a whole-number column; rows that
    lack it come last) and among equals, or without such a column, the lowest
    hash of the columns carried, which are all unless ``carry`` names some. It
    is an aggregate, not a window: each task first reduces its own rows to one
    per key, so a key that holds a third of the table sends one row per task
    through the shuffle. Rows with a NULL key count as one key.

    Nothing is sorted as long as what is carried are numbers. The day columns
    of a raw table are parts of its event time, so they join the key instead of
    being carried; any other text makes the aggregate sort its rows, twice, so
    name in ``carry`` what is needed.
    """
    columns = readings.columns if carry is None else [key, *carry]
    keys = [key, *(c for c in columns if c in DAY_COLUMNS and key == "base_datetime")]
    carried = [c for c in columns if c not in keys]
    if not carried:
        return readings.select(*columns).distinct()
    # A hash skips NULLs, so say where they are.
    told = [part for c in carried if c != tie_break for part in (F.col(c), F.col(c).isNull())]
    rank = F.xxhash64(*told) if told else F.lit(0).cast("long")
    if tie_break is not None:
        rank = _before(F.coalesce(F.col(tie_break).cast("long"), F.lit(LAST)), rank)
    survivors = (
        readings.withColumn("_rank", rank)
        .groupBy(*keys)
        .agg(*[F.min_by(c, "_rank").alias(c) for c in carried])
    )
    return survivors if survivors.columns == columns else survivors.select(*columns)


def dedup_wide(readings: DataFrame, key: str = "base_datetime", tie_break: str | None = None) -> DataFrame:
    """Keep one whole row per key, as ``dedup`` does, of rows with texts or other columns of any length.

    Columns of any length make an aggregate sort whole rows, so only numbers are
    aggregated: the lowest rank of each key, and a second hash of the row that has
    it. The rows are then met by key and both numbers, which spreads a key's rows over
    the tasks by what they hold; rows that repeat one another whole meet as one
    before that, within tasks first. Nothing is sorted. The join holds a partition of
    the keys with their two numbers in memory, no row: set the number of shuffle
    partitions for the distinct keys. Rows with a NULL key count as one key.
    """
    rest = [c for c in readings.columns if c not in (key, tie_break)]
    told = [part for c in rest for part in (F.col(c), F.col(c).isNull())]
    first = F.xxhash64(F.lit(1), *told)
    if tie_break is not None:
        first = _before(F.coalesce(F.col(tie_break).cast("long"), F.lit(LAST)), first)
    numbers = {"_first": first, "_second": F.xxhash64(F.lit(2), *told)}
    lowest = readings.withColumns(numbers).groupBy(F.col(key).alias("_key"))
    lowest = lowest.agg(F.min("_first").alias("_lowest"), F.min_by("_second", "_first").alias("_other"))
    met = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_first") == F.col("_lowest")) & (F.col("_second") == F.col("_other"))
    met_rows = readings.distinct().withColumns(numbers).join(lowest.hint("shuffle_hash"), met, "left_semi")
    return met_rows.select(*readings.columns)


def _before(first: Column, second: Column) -> Column:
    """A number that orders by the first long and then by the second's lower bits.

    It has a fixed width, unlike a struct, which would make the aggregate sort.
    """
    low = second.bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    high = first.cast("decimal(19,0)") * F.lit(1 << HASH_BITS).cast("decimal(19,0)")
    return (high + low.cast("decimal(19,0)")).cast("decimal(38,0)")
