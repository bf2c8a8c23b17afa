"""Exact dedup: group by a 128-bit content hash, compare the bytes inside groups."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text, written

KEEP = {"smallest": F.min, "largest": F.max}


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8, as binary."""
    return F.unhex(F.md5(text.cast("binary")))


def _distinct(rows: DataFrame, keep: str) -> DataFrame:
    """One row per different text: its hash, the id that stays, and how many rows hold it.

    The bytes themselves are a grouping key, so texts that share a hash stay
    apart. Each task first combines its own copies, so a text that fills a third
    of the table goes into the shuffle once per task.
    """
    return rows.groupBy("hash", "text").agg(
        KEEP[keep]("id").alias("keep_id"), F.count("*").alias("group_size")
    )


def _rows(docs: DataFrame, id_column: str, text_column: str, hashed) -> DataFrame:
    text = whole_text(text_column)
    return docs.select(F.col(id_column).alias("id"), text.alias("text"), hashed(text).alias("hash"))


def text_groups(
    docs: DataFrame,
    keep: str = "smallest",
    id_column: str = "doc_id",
    text_column: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """Written table, one row per hash: n_texts (1 unless texts collide), keep_id, group_size."""
    distinct = _distinct(_rows(docs, id_column, text_column, hashed), keep)
    groups = distinct.groupBy("hash").agg(
        F.count("*").alias("n_texts"),
        F.max("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
    )
    return written(groups, "text-groups")


def mark_copies(
    docs: DataFrame,
    keep: str = "smallest",
    id_column: str = "doc_id",
    text_column: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. Of a group the
    row with the smallest (or largest) id stays. Rows that repeat both the id and
    the text all count in group_size and share one verdict. A null id is never
    the one that stays unless its group has no other: then keep_id is null and
    every row of the group is kept. An empty table gives no rows. Texts of any length
    are hashed and compared whole. Other columns are not read.
    """
    arguments = (docs, id_column, text_column, hashed)
    groups = text_groups(docs, keep, id_column, text_column, hashed)
    digests = _rows(*arguments).select("id", "hash", F.sha2("text", 256).alias("text_sha256"))
    single = groups.filter("n_texts = 1").drop("n_texts")
    marked = digests.join(single, "hash")
    collided = groups.filter("n_texts > 1").select("hash")
    if not collided.isEmpty():
        among = _rows(*arguments).join(collided, "hash", "left_semi")
        marked = marked.select("id", "keep_id", "group_size", "text_sha256").unionByName(
            among.join(_distinct(among, keep), ["hash", "text"]).select(
                "id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")
            )
        )
    return marked.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(
    docs: DataFrame,
    keep: str = "smallest",
    id_column: str = "doc_id",
    text_column: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """The documents that stay, one of each different text, with all their columns.

    That of the smallest (or largest) id stays; a row without an id only where no
    row of its text has one. Of rows that repeat that id and text one stays. The
    bytes are a grouping key beside their hash, so texts that share a hash stay
    apart; each task first reduces its own copies to one. An empty table stays empty,
    very long texts count whole, and other columns may have any names.
    """
    text, others = F.col(text_column), [c for c in docs.columns if c != text_column]
    known = F.col(id_column).isNull() if keep == "smallest" else F.col(id_column).isNotNull()
    order = F.struct(known.alias("known"), F.col(id_column).alias("id"))
    row = F.struct(text.isNull().alias("no_text"), F.struct(*others).alias("others"))
    rows = docs.select(
        hashed(whole_text(text_column)).alias("hash"), whole_text(text_column).alias("text"), order.alias("order"), row.alias("row")
    )
    first = {"smallest": F.min_by, "largest": F.max_by}[keep]
    kept = rows.groupBy("hash", "text").agg(first("row", "order").alias("row"))
    columns = {c: F.col("row.others")[c] for c in others}
    columns[text_column] = F.when(~F.col("row.no_text"), F.col("text"))
    return kept.select(*[columns[c].alias(c) for c in docs.columns])
