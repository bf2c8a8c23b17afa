"""What the operators share: written intermediate tables, batches by bytes, label folds."""

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_folder

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SLICE_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back.

    Cuts the lineage: an executor lost later costs a read, not the work again.
    """
    path = new_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def _set_while(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, value)
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def freed_shuffles(spark: SparkSession):
    """While it lasts, shuffle files of a finished query go at once, where Spark can do that; what
    is read again has been written as a table."""
    return _set_while(spark, FREE_SHUFFLES, "true")


def small_batches(spark: SparkSession):
    """While it lasts, a batch that tasks hand to Python ends at SLICE_BYTES, also where rows are wide."""
    return _set_while(spark, BATCH_BYTES, str(SLICE_BYTES))


def whole_text(column: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def same_row(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, Column]:
    """Rows as (row, row_id, row_content), and the condition that a verdict (id, content) is on one.

    The content is a hash of the text: it tells rows apart that share an id or lack one.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_column).alias("row_id"),
        content(text_column).alias("row_content"),
    )
    return rows, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_content") == F.col("content"))


def content(text_column: str) -> Column:
    return F.xxhash64(whole_text(text_column))


def fold(column: str, folds: int) -> Column:
    """crc32 of the id's text, modulo folds; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds, F.lit(0))


def slices(batches: Iterator[pa.RecordBatch], texts: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that column number ``texts`` holds about ``most`` bytes in each.

    A longer row stands alone, so a task needs memory for one slice or one text.
    """
    for batch in batches:
        lengths = pc.binary_length(batch.column(texts)).fill_null(0).to_numpy()
        start, held = 0, 0
        for row, length in enumerate(lengths):
            if row > start and held + length > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        if start < batch.num_rows:
            yield batch.slice(start)


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, a block at a time: runs without U+0020 and U+0009 to U+000D."""
    start = 0
    while start < len(data):
        end = min(start + size, len(data))
        if end < len(data):
            blank = _BLANK.search(data, end)
            end = blank.start() if blank else len(data)
        yield data[start:end].split()
        start = end


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch of the given columns, lists or numpy arrays or Arrow arrays."""
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, kind.type)
        for c, kind in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
