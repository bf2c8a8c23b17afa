import base64
import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe, files, pieces, token_files
from tidemark.llm.pieces import PieceIds
from tidemark.session import new_folder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "ab's'tremvldLS 19½²\n\t\r　\xa0\x1c\x85é漢😀'!?_-  '"


@pytest.fixture(scope="module")
def library():
    lines = (line.split() for line in open(RANKS, "rb"))
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(RANKS, "rb").read())


def odd_texts(n=3000):
    rng = random.Random(5)
    texts = ["".join(rng.choices(LETTERS, k=rng.randint(0, 30))) for _ in range(n)]
    ranges = [range(0x20, 0x300), range(0x300, 0xD800), range(0xE000, 0x110000)]
    texts += ["".join(chr(rng.choice(rng.choice(ranges))) for _ in range(20)) for _ in range(n)]
    return [*texts, None, "", " ", "'", "'s", "it's'll", "a" * 5000, "é" * 3000, "\n\n a", "<|endoftext|>"]


def test_ids_equal_the_library(library, vocabulary):
    texts = odd_texts()
    ids, counts = PieceIds(vocabulary.encode_pieces).ids(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for text, end, count in zip(texts, ends, counts, strict=True):
        own = ids[end - count : end]
        assert own.tolist() == library.encode_ordinary(text or "")
        assert vocabulary.decode(own).decode() == (text or "")


def test_forgetting_pieces_changes_nothing(library, vocabulary):
    encoder = PieceIds(vocabulary.encode_pieces, most=50)
    for text in odd_texts(100):
        ids, _ = encoder.ids(pa.array([text], pa.string()))
        assert ids.tolist() == library.encode_ordinary(text or "")


@pytest.mark.parametrize("text", ["a" * 70000, "abcabd" * 3000, "é漢" * 4000, "=-" * 5000, "x" * 4097, "zq" * 2048])
def test_long_pieces(library, vocabulary, text):
    ids, _ = PieceIds(vocabulary.encode_pieces).ids(pa.array([text]))
    assert ids.tolist() == library.encode_ordinary(text)


def test_long_texts_are_cut_where_pieces_end(library, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "LONG_BYTES", 50)
    texts = [*odd_texts(300), "It's the words ' and  more\n\n words we'll see " * 50]
    ids, counts = PieceIds(vocabulary.encode_pieces).ids(pa.array(texts, pa.string()))
    assert ids.tolist() == [i for t in texts for i in library.encode_ordinary(t or "")]
    assert len(counts) == len(texts)


def test_pair_table_with_crowded_slots():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 1 << 40, 5000, dtype=np.uint64))
    table = bpe.PairTable(pairs, np.arange(len(pairs), dtype=np.uint32))
    left, right = (pairs >> np.uint64(32)).astype(np.uint32), (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    assert (table.ranks(left, right) == np.arange(len(pairs))).all()
    assert (table.ranks(left, right ^ np.uint32(1 << 20)) == bpe.NO_RANK).mean() > 0.99


def test_encode_query_and_round_trip(spark, docs, library):
    texts = odd_texts(200)
    table = docs(*enumerate(texts), extra="").repartition(4)
    found = {r.doc_id: r for r in bpe.encode_digests(table, RANKS).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    decoded = bpe.decode_ids(bpe.encode_texts(table, RANKS), RANKS)
    assert {r.doc_id: bytes(r.decoded).decode() for r in decoded.collect()} == {
        i: t or "" for i, t in enumerate(texts)
    }


def test_encode_empty_table_and_clashing_columns(spark, docs):
    assert bpe.encode_digests(docs(), RANKS).count() == 0
    table = spark.createDataFrame([(None, "a", 5, "x")], "doc_id long, text string, n_tokens int, ids string")
    assert bpe.encode_digests(table, RANKS).first()["n_tokens"] == 1


def expected_index(rows, end=2):
    library, start, out = Tokenizer.from_file(JSON), 0, []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("part_bytes", [1 << 24, 2000])
def test_token_files(spark, docs, part_bytes):
    rows = list(enumerate(odd_texts(300)))
    rows += [(900 + i, "some words again and again " * n) for i, n in enumerate((0, 1, 500))]
    manifest = token_files.write_tokens(
        docs(*rows[::-1]), new_folder(spark, "tokens"), JSON, 2, part_bytes=part_bytes
    )
    found = sorted(tuple(r) for r in token_files.read_index(spark, manifest).collect())
    assert found == expected_index(sorted(rows, key=lambda r: r[0]))


def test_files_are_flat_integers(spark, docs):
    manifest = token_files.write_tokens(docs((1, "a b"), (2, "")), new_folder(spark, "tokens"), JSON, 2)
    part = manifest.first()
    read = lambda suffix: files.mapped(part.path + suffix).read()
    assert np.frombuffer(read(".ids"), "<u2").tolist() == [64, 275, 2, 2]
    assert np.frombuffer(read(".offsets"), "<i8").tolist() == [0, 3, 4]
    assert np.frombuffer(read(".docs"), "<i8").tolist() == [1, 2]


def test_wide_ids_special_strings_and_other_tokenizers(spark, docs):
    table = docs((1, "a<|endoftext|>b"), (2, "plain"))
    manifest = token_files.write_tokens(table, new_folder(spark, "tokens"), JSON, 2)
    found = [tuple(r) for r in token_files.read_index(spark, manifest).orderBy("doc_id").collect()]
    assert found == expected_index([(1, "a<|endoftext|>b"), (2, "plain")])
    with pytest.raises(Exception, match="end id"):
        token_files.write_tokens(table, new_folder(spark, "tokens"), JSON, 1 << 16)
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = token_files.write_tokens(table, new_folder(spark, "tokens"), path, 2)
    ids = Tokenizer.from_file(path).encode("plain", add_special_tokens=False).ids
    counts = {r.doc_id: r.n_tokens for r in token_files.read_index(spark, manifest).collect()}
    assert counts[2] == len(ids) + 1


def test_token_files_null_ids_repeats_empty(spark, docs):
    rows = [(None, "x"), (None, "y z"), (3, "a"), (3, "a")]
    manifest = token_files.write_tokens(docs(*rows), new_folder(spark, "tokens"), JSON, 2)
    found = token_files.read_index(spark, manifest).collect()
    assert sorted(str(r.doc_id) for r in found) == ["3", "3", "None", "None"]
    assert sorted(r.start for r in found if r.doc_id is None)[0] == 0
    assert sum(r.n_tokens for r in found) == 2 + 3 + 2 + 2
    manifest = token_files.write_tokens(docs(), new_folder(spark, "tokens"), JSON, 2)
    assert token_files.read_index(spark, manifest).count() == 0


def test_query_over_documents(spark):
    from tidemark.llm.catalog import op5_token_files

    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()
    found = sorted(tuple(r) for r in op5_token_files(spark, folder).collect())
    assert found == expected_index(rows)
