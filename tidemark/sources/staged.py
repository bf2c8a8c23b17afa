"""Ranges of days that readers of a table see whole or not at all.

New days are written to a folder of their own below the table, which readers of
folders skip, then checked, then ordered in by one small file, and only then moved
to their places. The order is what commits the range: until it is there the table
is as it was, from then on ``read_committed`` takes the range from the new days
wherever they lie, and whoever writes next finishes the moves. One writer at a time.
"""

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import DAY_COLUMNS

ORDER = "_order"
STAGED = "_staged"
UNDATED = "__HIVE_DEFAULT_PARTITION__"


class IncompleteError(RuntimeError):
    """What has been staged is not what was to be written; the table is left as it was."""


def _place(spark: SparkSession, path: str) -> tuple:
    """A path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def day_folders(spark: SparkSession, root: str) -> dict[tuple[str, ...], str]:
    """Folder of each day of a table by its column values as the folders' names have them; the driver
    gets a name per day."""
    pattern, system = _place(spark, root + "".join(f"/{column}=*" for column in DAY_COLUMNS))
    folders = [status.getPath().toString() for status in system.globStatus(pattern) or []]
    return {tuple(part.split("=", 1)[1] for part in f.split("/")[-len(DAY_COLUMNS) :]): f for f in folders}


def _below(root: str, day: tuple[str, ...]) -> str:
    return root + "".join(f"/{column}={value}" for column, value in zip(DAY_COLUMNS, day, strict=True))


def read_order(spark: SparkSession, root: str) -> dict | None:
    """The order that has not been carried out yet: where the new days are, and which days go."""
    place, system = _place(spark, f"{root}/{ORDER}")
    if not system.exists(place):
        return None
    source = system.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    order = json.loads(text)
    return {"staged": f"{root}/{order['staged']}", "withdrawn": [tuple(day) for day in order["withdrawn"]]}


def _commit(spark: SparkSession, root: str, staged: str, withdrawn: list[tuple[str, ...]]) -> None:
    """Put the order in its place at once, whole."""
    draft, system = _place(spark, f"{root}/{ORDER}-{uuid.uuid4().hex}")
    out = system.create(draft)
    out.writeBytes(json.dumps({"staged": staged, "withdrawn": withdrawn}))
    out.close()
    if not system.rename(draft, _place(spark, f"{root}/{ORDER}")[0]):
        raise IncompleteError(f"another order stands at {root}")


def stage_days(frame: DataFrame, root: str, stands_for: Callable[[tuple[str, ...]], bool]) -> None:
    """Write days beside the table, check them, and order them in; ``settle`` moves them.

    The frame is all there is of the days, as their folders' values, that
    ``stands_for`` is true of: those of them that only the table holds are to go.
    Before that an order left by an earlier run is carried out.
    """
    spark = frame.sparkSession
    settle(spark, root)
    staged, written = f"{STAGED}-{uuid.uuid4().hex}", Observation()
    # Counted behind the shuffle, in the tasks that write, of which each counts once.
    counted = frame.hint("rebalance", *DAY_COLUMNS).observe(written, F.count(F.lit(1)).alias("n"))
    counted.write.partitionBy(*DAY_COLUMNS).parquet(f"{root}/{staged}")
    new = day_folders(spark, f"{root}/{staged}")
    _check(spark, frame.schema, f"{root}/{staged}", new, written.get.get("n", 0))
    withdrawn = [day for day in day_folders(spark, root) if day not in new and stands_for(day)]
    _commit(spark, root, staged, sorted(withdrawn))


def _check(spark: SparkSession, schema: StructType, path: str, days: dict, n: int) -> None:
    """Whether as many rows as were written are there to be read; takes the files' footers."""
    found = spark.read.schema(schema).parquet(path).count() if days else 0
    if found != n:
        raise IncompleteError(f"{found} of {n} rows at {path}")


def settle(spark: SparkSession, root: str) -> bool:
    """Carry out the order that stands, if there is one, from wherever an earlier run got to."""
    order = read_order(spark, root)
    if order is None:
        return False
    for day, folder in day_folders(spark, order["staged"]).items():
        _move(spark, folder, _below(root, day))
    for day in order["withdrawn"]:
        place, system = _place(spark, _below(root, day))
        system.delete(place, True)
    for path, whole in ((f"{root}/{ORDER}", False), (order["staged"], True)):
        place, system = _place(spark, path)
        system.delete(place, whole)
    return True


def _move(spark: SparkSession, folder: str, target: str) -> None:
    """Put a new day in the place of the old one; between the two steps it is still a staged day."""
    (source, system), (place, _) = _place(spark, folder), _place(spark, target)
    system.delete(place, True)
    system.mkdirs(place.getParent())
    if not system.rename(source, place):
        raise IncompleteError(f"{folder} could not be moved to {target}")


def _as_folder() -> Column:
    """The day columns as the folders' names have them."""
    year, month, day = (F.coalesce(F.col(c).cast("string"), F.lit(UNDATED)) for c in DAY_COLUMNS)
    return F.concat_ws("/", year, month, day)


def read_committed(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """A table as the last order has it, whether or not that has been carried out.

    It is the state at the time of the call; days moved between then and the
    reading of files end the query with an error for files not found, never with a mixture.
    """
    order = read_order(spark, root)
    table = spark.read.schema(schema).parquet(root)
    if order is None:
        return table
    waiting = day_folders(spark, order["staged"])
    gone = ["/".join(day) for day in [*waiting, *order["withdrawn"]]]
    kept = table.filter(~_as_folder().isin(gone)) if gone else table
    return kept.unionByName(spark.read.schema(schema).parquet(order["staged"])) if waiting else kept
