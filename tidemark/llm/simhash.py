"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprints of 64 bits are linked when they differ in at most three. Of four
16-bit segments one must then be free of errors, and of two 23-bit words taken
from the other 48 bits one holds at most one error. So two fingerprints that
link share a segment exactly, and for one of its two words the codeword that
the one decodes to is among the nearby codewords of the other. Every
fingerprint therefore gets a key (segment, its value, word, codeword index) for
each nearby codeword of each of the eight words, and only fingerprints that
share a key are compared, by all their bits.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    BLOCK_BYTES,
    content,
    record_batch,
    same_row,
    slices,
    whole_text,
    word_blocks,
    written,
)
from tidemark.llm.components import component_roots
from tidemark.llm.golay import LENGTH, nearby_codewords

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
SEGMENTS, SEGMENT_BITS = 4, 16
BLOCK_ROWS = 1 << 14

_KEYS = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
_LINKS = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("u", pa.int64()), ("v", pa.int64())])


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, block: int = BLOCK_BYTES) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 if it has no word.

    A-Z are lower-cased; words are runs without blanks (U+0020, U+0009 to
    U+000D). A bit is set if over half of the shingles' XXH64 have it. A text of
    fewer words has one shingle, all its words.
    """
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones, total, carried = np.zeros(64, np.int64), 0, []
    for found in word_blocks((text or "").encode().lower(), block):
        held = carried + found
        shingles = zip(*(held[i:] for i in range(words)), strict=False)
        hashes = np.array([digest(join(s), SEED) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
        carried = held[max(0, len(held) - words + 1) :]
    if not total and carried:
        return digest(join(carried), SEED)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, words: int = SHINGLE_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Written table, a row per row: id, content (a hash of the text) and fp, the fingerprint as a
    signed long. Null is empty."""
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            found = np.array([fingerprint(t, words) for t in part.column(1).to_pylist()], np.uint64)
            schema = pa.schema([part.schema.field(0), part.schema.field(2), ("fp", pa.int64())])
            yield record_batch(schema, part.column(0), part.column(2), found.view(np.int64))

    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), content(text_column).alias("content")
    )
    return written(rows.mapInArrow(run, f"id {kind}, content long, fp long"), "fingerprints")


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints (unsigned), and for each key the row it belongs to."""
    keys, owners = [], []
    rows = np.arange(len(fps))
    for segment in range(SEGMENTS):
        shift = np.uint64(segment * SEGMENT_BITS)
        exact = ((fps >> shift) & np.uint64(0xFFFF)).astype(np.int64)
        below = fps & ((np.uint64(1) << shift) - np.uint64(1))
        above = (fps >> (shift + np.uint64(SEGMENT_BITS - 1))) >> np.uint64(1)
        rest = below | above << shift  # the other 48 bits
        for word in range(2):
            bits = (rest >> np.uint64(24 * word)) & np.uint64((1 << LENGTH) - 1)
            near = nearby_codewords(bits)
            first = (segment * 2 + word) << 28 | exact << 12
            for place in range(near.shape[1]):
                own = rows if place == 0 else np.flatnonzero(near[:, place] != near[:, 0])
                keys.append(first[own] | near[own, place])
                owners.append(own)
    return np.concatenate(keys), np.concatenate(owners)


def stars(values: np.ndarray, most: int = MAX_DISTANCE) -> tuple[list[int], list[int]]:
    """Members and the least of each part that differences of at most ``most`` bits connect; the
    values are distinct, ascending and unsigned."""
    members, centres, left = [], [], values
    while len(left) > 1:
        centre, reached, left = int(left[0]), [left[0]], left[1:]
        while reached and len(left):
            near = np.bitwise_count(left ^ reached.pop()) <= most
            if near.any():
                found, left = left[near], left[~near]
                members += found.tolist()
                centres += [centre] * len(found)
                reached.extend(found)
    return members, centres


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


class _Groups:
    """Fingerprints grouped by key, from batches sorted by key; rows of links and of large groups."""

    def __init__(self, most: int, rows: int):
        self._most, self._rows = most, rows
        self._key, self._held, self._block = None, [], 0

    def _close_block(self, last: bool) -> pa.RecordBatch | None:
        """Link the block at hand; a group of several blocks also hands on its rows."""
        values = np.unique(np.concatenate(self._held).view(np.uint64))
        u, v = stars(values, self._most)
        out = [(np.full(len(u), -1), np.full(len(u), -1), _signed(u), _signed(v))]
        if not last or self._block:
            n = len(values)
            out.append((np.full(n, self._key), np.full(n, self._block), _signed(values), np.zeros(n, np.int64)))
        self._held, self._block = [], self._block + 1
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return record_batch(_LINKS, *columns) if len(columns[0]) else None

    def add(self, key: int, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        if key != self._key:
            yield from self.end()
            self._key, self._block = key, 0
        while len(values):
            room = self._rows - sum(map(len, self._held))
            self._held.append(values[:room])
            values = values[room:]
            if len(values) and (batch := self._close_block(False)):
                yield batch

    def end(self) -> Iterator[pa.RecordBatch]:
        if self._held and (batch := self._close_block(True)):
            yield batch


def _within_keys(most: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups(most, rows)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp = (c.to_numpy() for c in batch.columns)
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            inner = np.ones(len(starts), bool)
            inner[[0, -1]] = False  # these may go on in the batches beside this one
            pairs = starts[inner & (sizes == 2)]
            a, b = fp[pairs].view(np.uint64), fp[pairs + 1].view(np.uint64)
            near = np.bitwise_count(a ^ b) <= most
            if near.any():
                mark = np.full(int(near.sum()), -1)
                yield record_batch(_LINKS, mark, mark, fp[pairs][near], fp[pairs + 1][near])
            for at in np.flatnonzero(~inner | (sizes > 2)):
                yield from groups.add(int(key[starts[at]]), fp[starts[at] : starts[at] + sizes[at]])
        yield from groups.end()

    return run


def near_links(prints: DataFrame, most: int = MAX_DISTANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of fingerprints (column fp) that differ
    in at most ``most`` (up to 3) bits; written.

    Different fingerprints that share a key are compared in blocks of
    ``block_rows``; what turns out connected is linked to its least member, so a
    group yields fewer links than it has members, never all pairs. A larger group's blocks are then compared two by two, each pair of
    blocks in a task of its own.
    """
    if most > MAX_DISTANCE:
        raise ValueError("the keys find at most three different bits")

    def to_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            if len(fps):
                keys, owners = golay_keys(fps.view(np.uint64))
                yield record_batch(_KEYS, keys, fps[owners])

    links_ddl = "key long, block long, u long, v long"
    # Keys are some forty times the fingerprints, so their tasks must not be merged to few.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = prints.select("fp").distinct().repartition(tasks)
    keys = distinct.mapInArrow(to_keys, "key long, fp long")
    grouped = keys.repartition("key").sortWithinPartitions("key")
    found = written(grouped.mapInArrow(_within_keys(most, block_rows), links_ddl), "near-links")
    links = found.filter("key = -1").select("u", "v")
    large = found.filter("key <> -1")
    blocks = large.groupBy("key").agg(F.max("block").alias("last"))
    if blocks.isEmpty():
        return links
    pairs = (
        large.join(blocks, "key")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        .filter("other <> block")
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "u")
    )
    between = pairs.groupBy("key", "i", "j").applyInArrow(_pair_table(most), "u long, v long")
    return written(links.unionByName(between), "near-links")


def _pair_table(most: int):
    def run(table: pa.Table) -> pa.Table:
        u, v = stars(np.unique(table["u"].to_numpy().view(np.uint64)), most)
        return pa.table({"u": _signed(u), "v": _signed(v)})

    return run


def near_groups(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    most: int = MAX_DISTANCE,
    block_rows: int = BLOCK_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits) and component_id, the smallest id
    that links of at most ``most`` different bits reach.

    Texts without a word, null or empty, have fingerprint zero and are linked
    like any other. Copies share a fingerprint, so they meet as one. A component
    without any id has component_id null. Rows that repeat an id or a text each have
    their row. Very long texts are hashed block by block, whole. An empty table gives no
    rows. Other columns are not read.
    """
    prints = fingerprints(docs, words, id_column, text_column)
    return _labelled(prints, most, block_rows).select(
        F.col("id").alias(id_column),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def _rooted(prints: DataFrame, most: int, block_rows: int, first: Column) -> DataFrame:
    """Each fingerprint, the root of its component and the least ``first`` of its rows."""
    firsts = prints.groupBy("fp").agg(F.min(first).alias("first"))
    roots = component_roots(near_links(prints, most, block_rows))
    return firsts.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def _labelled(prints: DataFrame, most: int, block_rows: int) -> DataFrame:
    rooted = _rooted(prints, most, block_rows, F.col("id"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    members = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(written(members, "near-members"), "fp")


def drop_near(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    most: int = MAX_DISTANCE,
    id_column: str = "doc_id",
    text_column: str = "text",
    repeats: bool = True,
) -> DataFrame:
    """The documents that stay, one of each component (that of the smallest id), with all columns.

    Of texts that share the smallest id, or where no document of a component has
    an id, the text of the least hash stays. Rows that repeat the id and text that
    stay all do; without ``repeats`` one of them does. An empty table stays empty, very
    long texts count whole, and other columns may have any names.
    """
    prints = fingerprints(docs, words, id_column, text_column)
    pair = F.struct(F.col("id").isNull().alias("no_id"), "id", "content")
    least = _rooted(prints, most, BLOCK_ROWS, pair).groupBy("root").agg(F.min("first").alias("least"))
    stays = written(least.select("least.id", "least.content").distinct(), "near-stays")
    rows, same = same_row(docs, id_column, text_column)
    kept = rows.join(stays, same, "left_semi")
    if not repeats and not prints.groupBy("id", "content").count().filter("count > 1").isEmpty():
        kept = kept.withColumn("text", whole_text(f"row.{text_column}")).dropDuplicates(["row_id", "text"])
    return kept.select("row.*")
