"""Texts cut into the pieces that a byte-level BPE merges within, whole batches at a time.

The cut is that of the public pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

done with array operations: classes of characters, runs of a class, and the
pattern's rules for the blank before a run and for contractions. The pieces
tile the text, so they are an Arrow array over the batch's own bytes.
"""

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
LONG_BYTES = 8 << 20
_CUT = re.compile("[a-zA-Z] [a-zA-Z]")


@cache
def class_table() -> np.ndarray:
    """Class of every code point, as the tokenizer library itself sees it.

    With single bytes as its only tokens and a class as its pattern, the library
    encodes exactly the characters of that class.
    """
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = points.astype("<u4").tobytes().decode("utf-32-le")
    single = {bytes([b]): b for b in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        library = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        members = bytes(library.encode_ordinary(every)).decode()
        table[np.frombuffer(members.encode("utf-32-le"), "<u4")] = kind
    return table


def _code_points(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte at which each begins."""
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    if len(points) == len(data):
        return points, np.arange(len(data))
    return points, np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)


def piece_starts(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Bytes at which pieces begin, of texts laid end to end; ``ends``: where each text ends."""
    if not len(data):
        return np.zeros(0, np.int64)
    points, begins = _code_points(data)
    n = len(points)
    kind = class_table()[points]
    is_text_start = np.zeros(n + 1, bool)
    is_text_start[np.searchsorted(begins, np.concatenate([[0], ends]))] = True
    run_start = is_text_start.copy()
    run_start[1:n] |= kind[1:] != kind[:-1]
    cut = run_start[:n].copy()
    # The last of several blanks before other characters is a piece of its own,
    # or if it is U+0020 the head of what follows; so is a single U+0020.
    before = np.flatnonzero(run_start[1:n] & ~is_text_start[1:n] & (kind[: n - 1] == SPACE))
    cut[before] = True
    joins = before[points[before] == 0x20] + 1
    cut[joins] = False
    _contractions(points, kind, run_start, cut, joins, is_text_start)
    return begins[cut]


def _contractions(points, kind, run_start, cut, joins, is_text_start) -> None:
    """'s 't 'm 'd 're 've 'll where an apostrophe begins a piece."""
    n = len(points)
    marks = np.flatnonzero((points[: n - 1] == 0x27) & run_start[: n - 1] & run_start[1:n])
    joined = np.zeros(n, bool)
    joined[joins] = True
    marks = marks[~joined[marks] & (kind[marks + 1] == LETTER) & ~is_text_start[marks + 1]]
    if not len(marks):
        return
    first = points[marks + 1]
    same_run = (marks + 2 < n) & ~run_start[np.minimum(marks + 2, n)]
    second = np.where(same_run, points[np.minimum(marks + 2, n - 1)], 0)
    one = np.isin(first, [ord(c) for c in "stmd"])
    two = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e"))
    two |= (first == ord("l")) & (second == ord("l"))
    cut[marks[one | two] + 1] = False
    for where, length in ((marks[one], 2), (marks[two & ~one], 3)):
        rest = where + length
        rest = rest[rest < n]
        cut[rest[~run_start[rest]]] = True


def pieces_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All pieces of the texts (null: empty), and how many of them each text has."""
    lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    whole = b"".join(x.as_buffer() for x in texts if x.is_valid)
    starts = piece_starts(whole, ends[:-1] if len(ends) else ends)
    offsets = np.append(starts, len(whole)).astype(np.int32)
    array = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(whole)]
    )
    edges = np.searchsorted(starts, np.concatenate([[0], ends]))
    return array.dictionary_encode(), np.diff(edges)


def stretches(text: str, size: int) -> Iterator[str]:
    """The text cut before blanks between two letters, where every piece ends, into stretches of
    about ``size`` characters."""
    start = 0
    while len(text) - start > size and (cut := _CUT.search(text, start + size)):
        yield text[start : cut.start() + 1]
        start = cut.start() + 1
    if start < len(text):
        yield text[start:]


class PieceIds:
    """Ids of pieces, remembered from batch to batch up to ``most`` of them.

    ``encode``: from a list of pieces not met before to their ids, concatenated,
    and the number of ids of each.
    """

    def __init__(self, encode, most: int = 1 << 19):
        self._encode, self._most = encode, most
        self._clear()

    def _clear(self) -> None:
        self._known: dict[bytes, int] = {}
        self._ids = np.zeros(0, np.uint32)
        self._starts = np.zeros(1, np.int64)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the texts end to end, and the number of ids of each text.

        A very long text is taken in stretches, cut where no piece crosses.
        """
        lengths = pc.binary_length(texts).fill_null(0)
        if not len(texts) or pc.max(lengths).as_py() <= LONG_BYTES:
            return self._ids_of(texts)
        parts, counts = [], []
        for text in texts:
            found = [self._ids_of(pa.array([s]))[0] for s in stretches(text.as_py() or "", LONG_BYTES)]
            parts += found
            counts.append(sum(map(len, found)))
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.array(counts, np.int64)

    def _ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, counts = pieces_of(texts)
        distinct = pieces.dictionary.to_pylist()
        if len(self._known) + len(distinct) > self._most:
            self._clear()
        found = list(map(self._known.get, distinct))
        new = [p for p, at in zip(distinct, found, strict=True) if at is None]
        if new:
            ids, sizes = self._encode(new)
            self._known.update(zip(new, range(len(self._known), len(self._known) + len(new)), strict=True))
            self._ids = np.concatenate([self._ids, ids])
            self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
            found = list(map(self._known.__getitem__, distinct))
        place = np.array(found, np.int64)
        which = place[pieces.indices.to_numpy(zero_copy_only=False)]
        starts, sizes = self._starts[which], self._starts[which + 1] - self._starts[which]
        before = np.concatenate([[0], np.cumsum(sizes)])
        gather = np.repeat((starts - before[:-1]).astype(np.int32), sizes)
        gather += np.arange(before[-1], dtype=np.int32)
        edges = np.concatenate([[0], np.cumsum(counts)])
        return self._ids[gather], np.diff(before[edges])
