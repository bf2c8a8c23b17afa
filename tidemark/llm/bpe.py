"""Byte-level BPE encoding and decoding with padded matrices.

Pieces of similar length are the rows of one matrix. In each round every row
merges its leftmost pair of least rank; ranks come from a hash table of pairs,
looked up for the whole matrix at once. Rows with nothing left to merge leave
the matrix, and merged cells are closed up.
"""

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import record_batch, slices
from tidemark.llm.pieces import PieceIds

NO_RANK = np.uint32(0xFFFFFFFF)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
CELLS = 1 << 20
LONG_PIECE = 1 << 12
DIGESTS = pa.schema(
    [
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)


class PairTable:
    """Open-addressing hash table from a pair of ids to the id they merge into."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        self._bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 4))))
        self._keys = np.full(1 << self._bits, EMPTY, np.uint64)
        self._values = np.full(1 << self._bits, NO_RANK, np.uint32)
        slots, waiting = self._slot(pairs), np.arange(len(pairs))
        while len(waiting):
            free = waiting[self._keys[slots[waiting]] == EMPTY]
            self._keys[slots[free]] = pairs[free]
            mine = self._keys[slots[waiting]] == pairs[waiting]
            self._values[slots[waiting[mine]]] = merged[waiting[mine]]
            waiting = waiting[~mine]
            slots[waiting] = (slots[waiting] + 1) & ((1 << self._bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where it doesn't merge."""
        keys = left.astype(np.uint64) << np.uint64(32) | right
        out = np.full(keys.shape, NO_RANK, np.uint32)
        slots = self._slot(keys)
        found = self._keys[slots]
        hit = found == keys
        out[hit] = self._values[slots[hit]]
        open_ = np.flatnonzero(~hit & (found != EMPTY))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self._bits) - 1)
            found = self._keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self._values[slots[open_[hit]]]
            open_ = open_[~hit & (found != EMPTY)]
        return out


class Vocabulary:
    """Ranks of a .tiktoken file."""

    def __init__(self, content: bytes):
        lines = (line.split() for line in content.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self._bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.uint32)
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        self._pairs = PairTable(np.array(pairs, np.uint64), np.array(merged, np.uint32))

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and the number of ids of each.

        A piece that is a token is that token; the others go through the
        matrices, one for lengths up to 8, 16, 32 and so on, in blocks of
        bounded size. Rounds cost a row its length each, so pieces of more than
        ``LONG_PIECE`` bytes are merged with a heap instead.
        """
        known = [self.ranks.get(p, -1) for p in pieces]
        single = np.array(known, np.int64)
        rest = np.flatnonzero(single < 0)
        lengths = np.array([len(pieces[i]) for i in rest], np.int64)
        long = {int(i): self._merge_long(pieces[i]) for i in rest[lengths > LONG_PIECE]}
        rest, lengths = rest[lengths <= LONG_PIECE], lengths[lengths <= LONG_PIECE]
        width = np.maximum(8, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        sizes = np.ones(len(pieces), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for w in np.unique(width):
            rows = rest[width == w]
            step = max(1, CELLS // int(w))
            for start in range(0, len(rows), step):
                block = rows[start : start + step]
                ids, counts = self._merge([pieces[i] for i in block], int(w))
                sizes[block] = counts
                parts.append((block, ids))
        for i, ids in long.items():
            sizes[i] = len(ids)
            parts.append((np.array([i]), np.array(ids, np.uint32)))
        starts = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.uint32)
        whole = np.flatnonzero(single >= 0)
        out[starts[whole]] = single[whole]
        for block, ids in parts:
            counts = sizes[block]
            ends = np.cumsum(counts)
            out[np.arange(len(ids)) + np.repeat(starts[block] - ends + counts, counts)] = ids
        return out, sizes

    def _merge(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge a block of pieces of at most ``width`` bytes; ids end to end and counts."""
        n = np.array([len(p) for p in pieces], np.int64)
        filled = np.arange(width) < n[:, None]
        ids = np.zeros((len(pieces), width), np.uint32)
        ids[filled] = self._bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        done_ids = np.zeros_like(ids)
        counts = n.copy()
        at = np.arange(len(pieces))
        rank = np.full((len(pieces), width - 1), NO_RANK, np.uint32)
        pair = filled[:, 1:]
        rank[pair] = self._pairs.ranks(ids[:, :-1][pair], ids[:, 1:][pair])
        while len(at):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(at), np.int64)
            least = rank[np.arange(len(at)), best] if rank.shape[1] else np.full(len(at), NO_RANK)
            going = least != NO_RANK
            if not going.all():
                over = ~going
                done_ids[at[over], : ids.shape[1]] = ids[over]
                counts[at[over]] = n[over]
                at, ids, rank, n = at[going], ids[going], rank[going], n[going]
                best, least = best[going], least[going]
            if not len(at):
                break
            rows, cells = np.arange(len(at)), np.arange(ids.shape[1] - 1)
            ids[rows, best] = least
            ids = np.take_along_axis(ids, cells + (cells > best[:, None]), 1)
            rank = np.take_along_axis(rank, cells[:-1] + (cells[:-1] >= best[:, None]), 1)
            n -= 1
            for shift in (0, -1):  # the new id's pairs with what follows it and what precedes it
                left = best + shift
                r = rows[(left >= 0) & (left + 1 < n)]
                rank[r, left[r]] = self._pairs.ranks(ids[r, left[r]], ids[r, left[r] + 1])
        return done_ids[np.arange(width) < counts[:, None]], counts

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one piece, the next one always on top of a heap."""
        ids = self._bytes[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        waiting: list[tuple[int, int, int, int]] = []

        def consider(left: int, right: int) -> None:
            if left >= 0 and right < len(ids):
                rank = self.ranks.get(self.tokens[ids[left]] + self.tokens[ids[right]])
                if rank is not None:
                    heappush(waiting, (rank, left, ids[left], ids[right]))

        for left in range(len(ids) - 1):
            consider(left, left + 1)
        while waiting:
            rank, left, own, other = heappop(waiting)
            right = after[left]
            if ids[left] != own or right >= len(ids) or ids[right] != other:
                continue
            ids[left], ids[right], after[left] = rank, -1, after[right]
            if after[left] < len(ids):
                before[after[left]] = left
            consider(before[left], left)
            consider(left, after[left])
        return [i for i in ids if i >= 0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def _vocabulary(content: bytes) -> tuple[Vocabulary, PieceIds]:
    vocabulary = Vocabulary(content)
    return vocabulary, PieceIds(vocabulary.encode_pieces)


def shared_file(spark: SparkSession, path: str) -> Broadcast:
    """Content of a vocabulary file (a few megabytes at most), sent to each executor once."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_digests(
    docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode and decode every whole text; a row per row: id, n_tokens, ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers) and decoded_sha256 (of the decoded bytes).

    A null text is empty and gives no ids. Special tokens' strings are ordinary
    text. Rows that repeat an id or a text each have their row; an empty table gives
    none. Very long texts are encoded piece by piece, in stretches that end where a
    piece does. Other columns are not read.
    """
    content = shared_file(docs.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, encoder = _vocabulary(content.value)
        for part in slices(batches, 1):
            ids, counts = encoder.ids(part.column(1))
            ends = np.cumsum(counts)
            n, digests, decoded = [], [], []
            for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
                own = ids[end - count : end]
                n.append(count)
                digests.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(vocabulary.decode(own)).hexdigest())
            schema = pa.schema([part.schema.field(0), *DIGESTS])
            yield record_batch(schema, part.column(0), n, digests, decoded)

    kind = dict(docs.dtypes)[id_column]
    return docs.select(id_column, text_column).mapInArrow(
        run, f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode_texts(
    docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The ids themselves: id, ids array<long>."""
    content = shared_file(docs.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = _vocabulary(content.value)
        for part in slices(batches, 1):
            ids, counts = encoder.ids(part.column(1))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))
            schema = pa.schema([part.schema.field(0), ("ids", lists.type)])
            yield record_batch(schema, part.column(0), lists)

    kind = dict(docs.dtypes)[id_column]
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, ids array<long>")


def decode_ids(encoded: DataFrame, vocabulary_path: str, id_column: str = "doc_id") -> DataFrame:
    """Bytes of each row's ids: id, decoded binary."""
    content = shared_file(encoded.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = _vocabulary(content.value)
        for batch in batches:
            texts = [vocabulary.decode(np.array(ids or [], np.int64)) for ids in batch.column(1).to_pylist()]
            schema = pa.schema([batch.schema.field(0), ("decoded", pa.binary())])
            yield record_batch(schema, batch.column(0), texts)

    kind = dict(encoded.dtypes)[id_column]
    return encoded.select(id_column, "ids").mapInArrow(run, f"`{id_column}` {kind}, decoded binary")
