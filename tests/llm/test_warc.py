import base64
import hashlib
import random

import pytest

from tidemark.llm import files, warc
from tidemark.session import new_folder

SCHEMA = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least=0):
    out = []
    for page, _, html in rows:
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        size = len((html or "").encode())
        first = min(same, default=None)
        revisit = first is not None and first != page and size >= least
        out.append((page, size, digest(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def report(frame, **options):
    return sorted((tuple(r) for r in warc.archive_report(frame, **options).collect()), key=repr)


ROWS = [
    (3, "http://a/", "<p>x</p>"),
    (1, "http://b/ \r\nX: y", "<p>x</p>"),
    (2, None, None),
    (5, "http://c/", ""),
    (6, "http://é/", "é" * 40000),
    (7, "u", "é" * 40000),
    (8, "u", "\r\n\r\n0\r\n\r\nWARC/1.1\r\n"),
    (9, "u", "z" * (16 << 10)),
]


@pytest.mark.parametrize("least", [0, 1, 100])
def test_round_trip(spark, least):
    assert report(spark.createDataFrame(ROWS, SCHEMA), min_bytes=least) == expected(ROWS, least)


def test_repeated_rows_null_ids_extra_columns(spark):
    rows = [(4, "u", "a" * 50000)] * 2 + [(4, "u", "b"), (5, "u", "a" * 50000), (None, "u", "b")]
    rows += [(None, "u", "c")] * 2
    frame = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], SCHEMA + ", payload string, record_type int"
    )
    assert report(frame) == expected(rows)


def test_empty_table(spark):
    assert report(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize(("segment", "chunk"), [(300, 7), (1000, 5000), (1 << 20, 64)])
def test_segments_come_back_in_order(spark, segment, chunk):
    rng = random.Random(segment)
    rows = [(i, "u", "".join(rng.choices("abé\r\n0", k=rng.choice([0, 1, 99, 4000])))) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    folder = new_folder(spark, "warc")
    manifest = warc.write_archives(
        frame, folder, segment_bytes=segment, chunk_bytes=chunk, file_bytes=20000
    )
    found = warc.read_archives(spark, manifest).filter("record_type = 'response'")
    got = {(r.page_id, r.payload_bytes, r.payload_digest) for r in found.collect()}
    want = {(p, n, d) for p, n, d, kind, _ in expected(rows) if kind == "response"}
    assert got == want


def test_records_are_plain_warc(spark):
    record = b"".join(warc.page_records(7, "http://a/", b"hello", None, "2024-01-01T00:00:00Z", 1 << 20, 3))
    fields, block = warc.parse_record(next(warc._members(_Once(record))))
    assert fields["warc-type"] == "response" and fields["warc-target-uri"] == "http://a/"
    assert block.endswith(b"3\r\nhel\r\n2\r\nlo\r\n0\r\n\r\n")
    assert warc.payload_of(block) == b"hello"


class _Once:
    def __init__(self, data):
        self._data = data

    def read(self, _):
        data, self._data = self._data, b""
        return data


def _written(folder, records):
    path = f"{folder}/part.warc.gz"
    with files.create(path) as out:
        for record in records:
            out.write(record)
    return path


@pytest.mark.parametrize("lost", [0, 1, -1])
def test_a_lost_segment_is_an_error(spark, lost):
    records = list(warc.page_records(1, "u", b"x" * 5000, None, "2024-01-01T00:00:00Z", 1000, 100))
    del records[lost]
    path = _written(new_folder(spark, "warc"), records)
    manifest = spark.createDataFrame([(path, 1)], "path string, records long")
    with pytest.raises(Exception, match="lacks a segment"):
        warc.read_archives(spark, manifest).collect()


def test_a_repeated_segment_counts_once(spark):
    records = list(warc.page_records(1, "u", b"x" * 5000, None, "2024-01-01T00:00:00Z", 1000, 100))
    path = _written(new_folder(spark, "warc"), records + records[2:3])
    manifest = spark.createDataFrame([(path, 1)], "path string, records long")
    assert [r.payload_bytes for r in warc.read_archives(spark, manifest).collect()] == [5000]


def test_broken_framing():
    with pytest.raises(ValueError, match="chunk"):
        warc.from_chunks(b"3\r\nabcd\r\n0\r\n\r\n")
    assert warc.from_chunks(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
