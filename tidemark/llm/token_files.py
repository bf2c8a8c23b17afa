"""Token ids in flat binary files, with 64-bit offsets, written and read by tasks.

A part is three files of the same stem: ``.ids`` holds the ids of all its
documents end to end as unsigned integers (16 bits if the vocabulary allows,
else 32), ``.offsets`` the 64-bit offset of each document's first id and one
more for the end, ``.docs`` the 64-bit document ids. The manifest has a row per
part; where a part stands among all ids is the prefix sum of the parts before.
"""

import json
import zlib
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import files
from tidemark.llm.bpe import shared_file
from tidemark.llm.common import record_batch, slices, whole_text, written
from tidemark.llm.pieces import PieceIds

PART_BYTES = 16 << 20
MANIFEST = "path string, part int, n_docs long, n_null_docs long, n_tokens long, width int"
INDEX = "doc_id long, start long, n_tokens long, ids_crc32 long"
_MANIFEST = pa.schema(
    [
        ("path", pa.string()),
        ("part", pa.int32()),
        ("n_docs", pa.int64()),
        ("n_null_docs", pa.int64()),
        ("n_tokens", pa.int64()),
        ("width", pa.int32()),
    ]
)
_INDEX = pa.schema([(c.split()[0], pa.int64()) for c in INDEX.split(",")])


@cache
def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is
    printable Latin-1, else the next character from U+0100 on."""
    shown = {b: chr(b) for b in [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]}
    others = (b for b in range(256) if b not in shown)
    return shown | {b: chr(0x100 + i) for i, b in enumerate(others)}


class LibraryEncoder:
    """Ids of texts by the tokenizers library, without added special tokens.

    Where the tokenizer is a plain byte-level BPE its ids are those of its
    pieces, so the library's model encodes each different piece once. Texts that
    hold an added token's string, and all texts of any other tokenizer, go to the
    library whole.
    """

    def __init__(self, content: bytes):
        self._library = Tokenizer.from_str(content.decode())
        config = json.loads(content)
        before = config.get("pre_tokenizer") or {}
        self._by_piece = (
            config["model"]["type"] == "BPE"
            and not config.get("normalizer")
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and not config["model"].get("dropout")
        )
        self._added = [t["content"] for t in config.get("added_tokens", [])]
        self._pieces = PieceIds(self._encode_pieces)
        self.width = 2 if self._library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, shown = self._library.model.tokenize, byte_characters()
        found = [[t.id for t in tokenize(p.decode("latin-1").translate(shown))] for p in pieces]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each."""
        special = np.zeros(len(texts), bool)
        for token in self._added:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if self._by_piece and not special.any():
            return self._pieces.ids(texts)
        if self._by_piece:
            plain = pc.if_else(pa.array(special), "", texts)
            ids, sizes = self._pieces.ids(plain)
        else:
            special[:] = True
            ids, sizes = np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        rows = np.flatnonzero(special)
        for row, own in zip(rows, self._whole(texts.take(rows).to_pylist()), strict=True):
            parts[row] = np.array(own, np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


@lru_cache(maxsize=1)
def _encoder(content: bytes) -> LibraryEncoder:
    return LibraryEncoder(content)


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    part_bytes: int = PART_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode every whole text and write parts below the folder, documents in ascending id;
    the written manifest.

    Each document's ids end with ``end_id``; a null text is empty, so has that id
    alone. Documents without an id come first. Rows that repeat an id all stay,
    in any order among themselves. A very long text is encoded whole and lies in one
    part. An empty table gives no parts. Other columns are not read.
    """
    spark = docs.sparkSession
    content = shared_file(spark, tokenizer_path)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    # The hash lets rows without an id, or with one id, spread over several parts.
    ordered = rows.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        kind = np.dtype(f"<u{encoder.width}")
        if end_id >= 1 << (8 * encoder.width):
            raise ValueError("the end id does not fit the files' integers")
        stem = files.attempt_path(folder, "")
        ids_file, total, nulls, written_docs = None, 0, 0, 0
        offsets, names = [np.zeros(1, np.int64)], []
        for part in slices(batches, 1):
            if ids_file is None:
                ids_file = files.create(stem + ".ids")
            ids, sizes = encoder.encode(part.column(1))
            ends = np.cumsum(sizes)
            ids_file.write(np.insert(ids, ends, end_id).astype(kind).tobytes())
            offsets.append(total + ends + np.arange(1, len(ends) + 1))
            total, written_docs = int(offsets[-1][-1]), written_docs + len(ends)
            nulls += part.column(0).null_count
            names.append(part.column(0).fill_null(0).to_numpy())
        if ids_file is None:
            return
        ids_file.close()
        for suffix, arrays in ((".offsets", offsets), (".docs", names)):
            with files.create(stem + suffix) as out:
                out.write(np.concatenate(arrays).astype("<i8").tobytes())
        row = (stem, TaskContext.get().partitionId(), written_docs, nulls, total, encoder.width)
        yield record_batch(_MANIFEST, *([value] for value in row))

    return written(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_index(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """A row per document of the files: doc_id, start (ids before it in all parts), n_tokens and
    ids_crc32 of its ids as little-endian unsigned 32-bit integers.

    The parts' bases are a running sum over the manifest, a row per file.
    """
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                offsets, names = (
                    np.frombuffer(files.mapped(row["path"] + suffix).read(), "<i8")
                    for suffix in (".offsets", ".docs")
                )
                width = row["width"]
                with files.mapped(row["path"] + ".ids") as source:
                    sums = []
                    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                        source.seek(start * width)
                        own = np.frombuffer(source.read_buffer((end - start) * width), f"<u{width}")
                        sums.append(zlib.crc32(own.astype("<u4").tobytes()))
                docs = pa.array(names, mask=np.arange(len(names)) < row["n_null_docs"])
                yield record_batch(_INDEX, docs, row["base"] + offsets[:-1], np.diff(offsets), sums)

    count = max(1, manifest.count())
    return based.repartition(count).mapInArrow(read, INDEX)
