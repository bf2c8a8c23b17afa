"""WARC archives: write records in segments and chunked framing, read and reassemble them."""

import base64
import datetime as dt
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import files
from tidemark.llm.common import slices, written
from tidemark.session import new_folder

CRLF = b"\r\n"
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
FILE_BYTES = 128 << 20

MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64())])
PART = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to_record", pa.string()),
        ("segment", pa.int64()),
        ("total_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("block", pa.binary()),
        ("payload_bytes", pa.int64()),
    ]
)
WHOLE = (
    "record_id string, page_id long, record_type string, refers_to_record string,"
    " payload_bytes long, payload_digest string"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def to_chunks(payload: bytes, size: int) -> bytes:
    """The payload in chunked transfer framing."""
    out = bytearray()
    for start in range(0, len(payload), size):
        piece = payload[start : start + size]
        out += b"%x\r\n%b\r\n" % (len(piece), piece)
    return bytes(out + b"0\r\n\r\n")


def from_chunks(body: bytes) -> bytes:
    """The payload of a body in chunked framing; extensions and trailers are skipped."""
    out, at = bytearray(), 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return bytes(out)
        at = end + 2
        if body[at + size : at + size + 2] != CRLF:
            raise ValueError("a chunk does not end where its size says")
        out += body[at : at + size]
        at += size + 2


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)
    whole = head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + CRLF * 2
    member = zlib.compressobj(3, zlib.DEFLATED, 31)
    return member.compress(whole) + member.flush()


def _urn(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def page_records(
    page_id, url: str | None, payload: bytes, refers_to, date: str, segment_bytes: int, chunk_bytes: int
) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and what continues it."""
    digest = sha1_base32(payload)
    origin = _urn(page_id, digest)
    common = [("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        common.append(("WARC-Target-URI", "".join(url.split())))
    if page_id is not None:
        common.append(("Page-Id", str(page_id)))
    http = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        yield _record(
            [
                ("WARC-Type", "revisit"),
                ("WARC-Record-ID", origin),
                *common,
                ("WARC-Profile", REVISIT_PROFILE),
                ("WARC-Refers-To", _urn(refers_to, digest)),
                http,
            ],
            HTTP_HEAD,
        )
        return
    block = HTTP_HEAD + to_chunks(payload, chunk_bytes)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", origin), *common, http]
    if len(block) <= segment_bytes:
        yield _record(first, block)
        return
    starts = range(0, len(block), segment_bytes)
    for number, start in enumerate(starts, 1):
        part = block[start : start + segment_bytes]
        if number == 1:
            yield _record([*first, ("WARC-Segment-Number", "1")], part)
            continue
        fields = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", _urn(page_id, digest, number)),
            ("WARC-Date", date),
            ("WARC-Segment-Origin-ID", origin),
            ("WARC-Segment-Number", str(number)),
        ]
        if number == len(starts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(fields, part)


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    file_bytes: int = FILE_BYTES,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Write a record per page into gzipped archives below the folder; the written manifest.

    The payload is the html in UTF-8, null as empty. Of equal payloads of at least
    ``min_bytes`` the one with the smallest id is a response, the others revisit
    it; rows that repeat that id and payload are responses too, and where no page
    of a group has an id all are. Payloads are told apart by SHA-256 and length.
    A block longer than ``segment_bytes`` goes on in continuation records. Other
    columns are not read.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(url_column).alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).cast("binary").alias("payload"),
    )
    keys = rows.select("id", F.unhex(F.sha2("payload", 256)).alias("key"), F.length("payload").alias("size"))
    firsts = keys.groupBy("key", "size").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    repeats = firsts.filter((F.col("n") > 1) & (F.col("size") >= min_bytes)).drop("n")
    revisits = (
        keys.join(repeats, ["key", "size"])
        .filter("NOT id <=> first AND first IS NOT NULL")
        .select("id", "key", "first")
        .distinct()
    )
    keyed = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    pointed = keyed.alias("p").join(
        revisits.alias("r"), F.expr("p.id <=> r.id AND p.key = r.key"), "left"
    )
    day = dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches):
        out = path = None
        records, held = 0, 0
        for part in slices(batches, 2):
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for record in page_records(page_id, url, payload, first, day, segment_bytes, chunk_bytes):
                    if out is None:
                        path = files.attempt_path(folder, ".warc.gz")
                        out = files.create(path)
                    out.write(record)
                    records, held = records + 1, held + len(record)
                if held >= file_bytes:
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"path": path, "records": records}], MANIFEST)
                    out, records, held = None, 0, 0
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "records": records}], MANIFEST)

    manifest = pointed.select("p.id", "p.url", "p.payload", "r.first").mapInArrow(
        write, "path string, records long"
    )
    return written(manifest, "warc-manifest")


def _members(source) -> Iterator[bytes]:
    """The members of a gzip stream, one at a time."""
    data, member, out = b"", zlib.decompressobj(31), []
    while True:
        if not data:
            data = source.read(1 << 20)
            if not data:
                if out:
                    raise ValueError("an archive ends inside a record")
                return
        out.append(member.decompress(data))
        data = member.unused_data
        if member.eof:
            yield b"".join(out)
            member, out = zlib.decompressobj(31), []
        elif data:
            raise ValueError("an archive is damaged")


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, names in lower case, and block of a record."""
    head, _, rest = member.partition(CRLF * 2)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    if rest[length:] != CRLF * 2:
        raise ValueError("a record does not end where its length says")
    return fields, rest[:length]


def payload_of(block: bytes) -> bytes:
    """Payload of an HTTP response block, its transfer framing removed."""
    head, _, body = block.partition(CRLF * 2)
    chunked = any(
        name.strip().lower() == b"transfer-encoding" and value.strip().lower() == b"chunked"
        for name, _, value in (x.partition(b":") for x in head.split(CRLF)[1:])
    )
    return from_chunks(body) if chunked else body


def _checked(block: bytes, digest: str | None) -> tuple[int, str]:
    payload = payload_of(block)
    found = sha1_base32(payload)
    if digest is not None and digest != found:
        raise ValueError("a payload does not have its digest")
    return len(payload), found


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every response and revisit of the archives listed in column path.

    record_id, page_id, record_type, refers_to_record, payload_bytes and
    payload_digest; of revisits the last two are those of the record they refer
    to. Segments of a record are gathered by their origin, ordered by number,
    held against the total length and joined. A segment that came twice with the
    same content counts once for each time the first segment came. A missing
    segment, wrong length, broken framing or wrong digest ends the job with an
    error, as does a revisit of a record that is not there.
    """
    count = max(1, manifest.count())

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.stream(path) as source:
                    for member in _members(source):
                        row = _part(*parse_record(member))
                        if row is not None:
                            rows.append(row)
                            held += 200 + len(row["block"] or b"")
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, PART)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, PART)

    parts = written(
        manifest.select("path").repartition(count).mapInArrow(read, _ddl(PART)), "warc-parts"
    )
    names = [c.split()[0] for c in WHOLE.split(",")]
    whole = parts.filter("segment IS NULL").select(*names)
    pieces = parts.filter("segment IS NOT NULL").groupBy("record_id").agg(
        F.array_sort(F.collect_set(F.struct("segment", "block"))).alias("blocks"),
        F.max("total_bytes").alias("total_bytes"),
        F.max("page_id").alias("page_id"),
        F.max("payload_digest").alias("payload_digest"),
        F.count_if(F.col("segment") == 1).alias("times"),
    )
    joined = pieces.mapInArrow(_reassembled, WHOLE)
    records = whole.unionByName(joined)
    responses = records.filter("record_type = 'response'")
    targets = responses.groupBy(F.col("record_id").alias("target")).agg(
        F.max("payload_bytes").alias("bytes"), F.max("payload_digest").alias("digest")
    )
    revisits = (
        records.filter("record_type = 'revisit'")
        .join(targets, F.col("refers_to_record") == F.col("target"), "left")
        .select(
            "record_id",
            "page_id",
            "record_type",
            "refers_to_record",
            F.coalesce("bytes", F.raise_error(F.lit("a revisit refers to no record")).cast("long")).alias(
                "payload_bytes"
            ),
            "payload_digest",
        )
    )
    return responses.unionByName(revisits)


def _part(fields: dict[str, str], block: bytes) -> dict | None:
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit", "continuation"):
        return None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    segment = fields.get("warc-segment-number")
    page = fields.get("page-id")
    row = {
        "record_id": fields.get("warc-segment-origin-id") or fields["warc-record-id"],
        "page_id": int(page) if page else None,
        "record_type": kind,
        "refers_to_record": fields.get("warc-refers-to"),
        "segment": int(segment) if segment else None,
        "total_bytes": int(fields["warc-segment-total-length"])
        if "warc-segment-total-length" in fields
        else None,
        "payload_digest": digest,
        "block": block if segment else None,
        "payload_bytes": None,
    }
    if kind == "response" and not segment:
        row["payload_bytes"], row["payload_digest"] = _checked(block, digest)
    return row


def _reassembled(batches):
    for batch in batches:
        rows = []
        for piece in batch.to_pylist():
            numbers = [x["segment"] for x in piece["blocks"]]
            block = b"".join(x["block"] for x in piece["blocks"])
            if numbers != list(range(1, len(numbers) + 1)) or len(block) != piece["total_bytes"]:
                raise ValueError(f"record {piece['record_id']} lacks a segment")
            size, digest = _checked(block, piece["payload_digest"])
            row = {
                "record_id": piece["record_id"],
                "page_id": piece["page_id"],
                "record_type": "response",
                "refers_to_record": None,
                "payload_bytes": size,
                "payload_digest": digest,
            }
            rows += [row] * piece["times"]
        yield pa.RecordBatch.from_pylist(rows, _WHOLE_ARROW)


_WHOLE_ARROW = pa.schema(
    [(n, pa.int64() if k == "long" else pa.string()) for n, k in (c.split() for c in WHOLE.split(","))]
)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def archive_report(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages written to archives in the shared folder and read back, a row per page:
    page_id, payload_bytes, payload_digest, record_type, refers_to (a page id).

    A null payload is empty. Of equal payloads the rows of the smallest page id are responses
    and the others revisit it, also those without an id; without any id all are responses.
    Rows that repeat a page id each have their record. Long payloads are written in segments
    and put together again. An empty table gives no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    manifest = write_archives(pages, folder, min_bytes)
    records = written(read_archives(spark, manifest), "warc-records")
    targets = (
        records.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("target"))
        .agg(F.max("page_id").alias("refers_to"))
    )
    referring = records.filter("record_type = 'revisit'").join(
        targets, F.col("refers_to_record") == F.col("target")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = records.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return first.select(columns).unionByName(referring.select(columns))
