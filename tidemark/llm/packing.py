"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the longest sequence are cut into pieces of that length,
which fill a sequence each, and a rest. Pieces are packed in shards of bounded
size, each by best-fit decreasing with bins of all permitted lengths at once: a
piece goes to the open bin it leaves the least room in; where none has room, a
bin of the length opens that costs least for each token it is expected to hold.
In the end every bin shrinks to the shortest permitted length that holds it.
"""

from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text, written

LENGTHS = (2048, 4096, 8192, 16384, 32768)
SHARD_TOKENS = 1 << 26
SHARD_PIECES = 1 << 17
REPEAT_RUN = 1 << 14
# Cost of a sequence of n tokens: n, a fixed part, and a part for attention, n * n / ATTENTION.
FIXED_COST = 64.0
ATTENTION = 1 << 18

PLACED = "doc_id long, piece int, piece_start long, n_tokens int, bin_id string, bin_length int, bin_offset int"


def sequence_cost(length: float) -> float:
    return FIXED_COST + length + length * length / ATTENTION


class _Remaining:
    """Tokens of the pieces not yet placed, where pieces come in descending length."""

    def __init__(self, sizes: np.ndarray):
        self._lengths, counts = np.unique(sizes, return_counts=True)
        self._sums = np.concatenate([[0], np.cumsum(self._lengths * counts)])

    def fitting(self, room: int, placed_of_length: int, length: int) -> float:
        """Tokens in unplaced pieces of at most ``room``; all longer than ``length`` are placed."""
        at = bisect_right(self._lengths, min(room, length))
        return float(self._sums[at]) - (placed_of_length * length if room >= length else 0)


def pack(sizes: np.ndarray, lengths: Sequence[int] = LENGTHS) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Pack pieces given in descending size: bin and offset of each, and each bin's final length.

    Bins of equal room are filled in the order in which they came to have it.
    """
    lengths = sorted(lengths)
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    capacity: list[int] = []
    rooms: dict[int, deque] = {}
    open_rooms = 0  # bit r is set if an open bin has room r
    remaining = _Remaining(sizes)
    same, of_size = None, 0
    for i, size in enumerate(sizes.tolist()):
        if size != same:
            same, of_size = size, 0
        of_size += 1
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = rooms[room].popleft()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        else:
            own, room = len(filled), _opened(size, of_size, lengths, remaining)
            filled.append(0)
            capacity.append(room)
        bins[i], offsets[i] = own, filled[own]
        filled[own] += size
        room -= size
        if room:
            rooms.setdefault(room, deque()).append(own)
            open_rooms |= 1 << room
    return bins, offsets, [lengths[bisect_left(lengths, n)] for n in filled]


def _opened(size: int, of_size: int, lengths: list[int], remaining: _Remaining) -> int:
    """Length of the bin to open for a piece: least cost for each token it may come to hold."""

    def cost_per_token(length: int) -> tuple[float, int]:
        room = length - size
        return sequence_cost(length) / (size + min(room, remaining.fitting(room, of_size, size))), length

    return min((n for n in lengths if n >= size), key=cost_per_token)


def _shard_rows(lengths: tuple[int, ...]):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        table = table.sort_by(
            [("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("piece_start", "ascending")]
        )
        bins, offsets, final = pack(table["n_tokens"].to_numpy(), lengths)
        names = [f"{shard}-{b}" for b in bins.tolist()]
        final = np.array(final, np.int32)
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "piece": table["piece"],
                "piece_start": table["piece_start"],
                "n_tokens": table["n_tokens"],
                "bin_id": pa.array(names),
                "bin_length": pa.array(final[bins], pa.int32()),
                "bin_offset": pa.array(offsets.astype(np.int32)),
            }
        )

    return run


def byte_tokens(text_column: str = "text") -> Column:
    """Tokens of a byte-level vocabulary: one for each byte, and the end of the document."""
    return F.octet_length(whole_text(text_column)).cast("long") + 1


def _numbered(sized: DataFrame, run: int = REPEAT_RUN) -> DataFrame:
    """The rows (doc_id, size) with a number, ``repeat`` from 1, among those that repeat both.

    Such rows are alike, so they are counted, which each task does for its own
    first, and made again with their numbers: in runs of bounded length, dealt
    to the tasks by doc_id, size and the run's start.
    """
    counted = sized.groupBy("doc_id", "size").count()
    starts = F.sequence(F.lit(1).cast("long"), F.col("count"), F.lit(run).cast("long"))
    runs = counted.withColumn("start", F.explode(starts)).repartition("doc_id", "size", "start")
    end = F.least("count", F.col("start") + run - 1)
    return runs.select("doc_id", "size", F.explode(F.sequence("start", end)).alias("repeat"))


def pack_documents(
    docs: DataFrame,
    lengths: Sequence[int] = LENGTHS,
    tokens: Column | None = None,
    shard_tokens: int = SHARD_TOKENS,
    shard_pieces: int = SHARD_PIECES,
    id_column: str = "doc_id",
) -> DataFrame:
    """A row for each piece of each document: doc_id, piece (from 0), piece_start and n_tokens
    within the document, bin_id, bin_length (a permitted length) and bin_offset.

    ``tokens`` is the length of a document, by default its bytes and an end token,
    null text as empty; documents of length 0 are left out, as they have nothing
    to place. Rows that repeat an id are documents of their own. The number of
    shards follows the tokens and the pieces, so no task holds more than a shard;
    a document is dealt to one by a hash of its id, its length and its number
    among the rows that repeat both. A document of any length is cut into pieces of the
    longest bin, the last one as long as what is left. An empty table gives no rows.
    Other columns are not read.
    """
    lengths = tuple(sorted(lengths))
    longest = lengths[-1]
    size = byte_tokens() if tokens is None else tokens.cast("long")
    sized = docs.select(F.col(id_column).cast("long").alias("doc_id"), size.alias("size")).filter("size > 0")
    sized = written(_numbered(sized), "document-lengths")
    rest = F.col("size") % longest
    total = sized.agg(F.sum(rest), F.count_if(rest > 0)).first()
    shards = max(1, -(-(total[0] or 0) // shard_tokens), -(-(total[1] or 0) // shard_pieces))
    full = (
        sized.filter(F.col("size") >= longest)
        .select(
            "doc_id",
            "repeat",
            F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("size") - longest, F.lit(longest).cast("long"))).alias(
                "piece", "piece_start"
            ),
        )
        .select(
            "doc_id",
            "piece",
            "piece_start",
            F.lit(longest).alias("n_tokens"),
            F.format_string("full-%s-%s-%s", "doc_id", "repeat", "piece").alias("bin_id"),
            F.lit(longest).alias("bin_length"),
            F.lit(0).alias("bin_offset"),
        )
    )
    rests = sized.filter(rest > 0).select(
        "doc_id",
        F.floor(F.col("size") / longest).cast("int").alias("piece"),
        (F.col("size") - rest).alias("piece_start"),
        rest.cast("int").alias("n_tokens"),
        F.pmod(F.xxhash64("doc_id", "size", "repeat"), F.lit(shards)).alias("shard"),
    )
    packed = rests.groupBy("shard").applyInArrow(_shard_rows(lengths), PLACED)
    return full.unionByName(packed)


def bins(placed: DataFrame) -> DataFrame:
    """A row per sequence: bin_id, bin_length, n_pieces and n_tokens."""
    return placed.groupBy("bin_id").agg(
        F.max("bin_length").alias("bin_length"),
        F.count("*").alias("n_pieces"),
        F.sum("n_tokens").alias("n_tokens"),
    )
