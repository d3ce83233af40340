"""WARC archives with one Zstandard frame per record and an embedded dictionary.

A dictionary is built from a bounded sample of the records. Every archive file begins
with a skippable frame (magic 0x184D2A5D) that holds it; each record follows as a
frame of its own, so single records can be read by offset. Equal payloads are stored
once: the smallest page is the response, the others are revisit records.

Files are written by Spark's own text sink, whose commit protocol makes lost and
repeated tasks harmless and which reaches any store Spark can write to. It ends each
row with a line break; each row therefore ends with the head of a skippable frame of
one byte, which that line break fills. A task begins a new file, with its dictionary,
every ``RECORDS_PER_FILE`` records, which bounds what a reader holds.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm import common

common.ship(sys.modules[__name__])

RECORDS_PER_FILE = 2048
SAMPLE_RECORDS = 1000
SAMPLE_BYTES = 1 << 16
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the formats.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
PADDING = b"\x50\x2a\x4d\x18\x01\x00\x00\x00"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
UNKNOWN_URI = "urn:unknown"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def _uri(url: str | None) -> str:
    """A URI fit for a header line."""
    return UNKNOWN_URI if not url else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record; of a revisit only the HTTP head is kept."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(url)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP head and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; of samples too few or too alike to train on, their text itself."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary_frame(dictionary: bytes) -> bytes:
    return DICTIONARY_MAGIC + struct.pack("<I", len(dictionary)) + dictionary


def _write_batches(dictionary: bytes, per_file: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        written = 0
        for batch in batches:
            out = []
            for page_id, url, html, refers_to, revisit in zip(*(batch.column(k) for k in range(5))):
                if written % per_file == 0:
                    out.append(_dictionary_frame(dictionary) + PADDING)
                data = record(page_id.as_py(), url.as_py(), html.as_py(), refers_to.as_py(), revisit.as_py())
                out.append(packer.compress(data) + PADDING)
                written += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    return write


def frames(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Magic number and bytes of each frame, skippable ones with their content only."""
    at = 0
    while at < len(data):
        magic = data[at : at + 4]
        if magic == FRAME_MAGIC:
            end = at + zstandard.frame_header_size(data[at : at + 18])
            checksum = data[at + 4] >> 2 & 1
            last = False
            while not last:
                head = int.from_bytes(data[end : end + 3], "little")
                last, kind, size = head & 1, head >> 1 & 3, head >> 3
                # A run-length block stores one byte.
                end += 3 + (1 if kind == 1 else size)
            end += 4 * checksum
            yield magic, data[at:end]
        elif magic[1:] == DICTIONARY_MAGIC[1:] and 0x50 <= magic[0] <= 0x5F:
            (size,) = struct.unpack_from("<I", data, at + 4)
            end = at + 8 + size
            yield magic, data[at + 8 : end]
        else:
            raise ValueError(f"no frame at byte {at}")
        at = end


def read_records(data: bytes) -> Iterator[bytes]:
    """The records of one archive file."""
    unpacker = zstandard.ZstdDecompressor()
    for magic, content in frames(data):
        if magic == DICTIONARY_MAGIC:
            unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        elif magic == FRAME_MAGIC:
            yield unpacker.decompress(content)


_READ = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            for data in read_records(content.as_py()):
                fields, http, payload = parse_record(data)
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                if kind == "response" and payload_digest(payload) != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                size = int(http.decode().rsplit("Content-Length: ", 1)[1])
                uri = fields["WARC-Target-URI"]
                rows.append(
                    {
                        "page_id": _number(fields.get("X-Page-ID")),
                        "payload_bytes": size,
                        "payload_digest": digest,
                        "record_type": kind,
                        "refers_to": _number(fields.get("X-Refers-To-Page-ID")),
                        "url": None if uri == UNKNOWN_URI else uri,
                        "payload": payload if kind == "response" else None,
                    }
                )
                held += len(data)
                if held > 1 << 24:
                    yield pa.RecordBatch.from_pylist(rows, _READ)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, _READ)


def write_archives(pages: DataFrame, folder: str, per_file: int = RECORDS_PER_FILE) -> bytes:
    """Write a record per row of ``page_id``, ``url``, ``html`` below ``folder``; returns the dictionary.

    A null html is an empty payload. Of equal payloads, also empty ones, the smallest
    page_id is the response and the others revisit it; rows alike in page_id and
    payload are written alike. A null page_id counts as larger than any other. An
    empty table gives no archive files; other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    # Stored, so that the join below has an exchange of its own on either side and
    # adaptive execution can split a digest that many pages share.
    least = common.store(rows.groupBy("digest").agg(F.min("page_id").alias("least")), "least-pages")
    dictionary = build_dictionary(_sample(rows))
    linked = rows.join(least, "digest").withColumn("revisit", ~F.col("page_id").eqNullSafe(F.col("least")))
    records = linked.select("page_id", "url", "html", F.when(F.col("revisit"), F.col("least")).alias("refers_to"), "revisit")
    packed = records.mapInArrow(_write_batches(dictionary, per_file), "value binary")
    sink = packed.select(F.col("value").cast("string")).write.option("compression", "none")
    # Each file also holds its dictionary as a row.
    sink.option("maxRecordsPerFile", per_file + 1).option("lineSep", "\n").text(folder)
    return dictionary


def _sample(rows: DataFrame) -> list[bytes]:
    """The first bytes of at most ``SAMPLE_RECORDS`` records, those of the smallest hashes."""
    ids = rows.select("digest", "page_id").orderBy(F.xxhash64("digest"), "page_id").limit(SAMPLE_RECORDS)
    # At most SAMPLE_RECORDS pairs.
    chosen = F.broadcast(ids.select("digest").distinct())
    texts = rows.join(chosen, "digest").select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html"), "digest")
    texts = texts.orderBy(F.xxhash64("digest"), "page_id").limit(SAMPLE_RECORDS)
    return [record(r.page_id, r.url, bytes(r.html)) for r in texts.collect()]


def read_archives(spark, folder: str) -> DataFrame:
    """Rows of all records: the columns of the contract, ``url`` and ``payload`` (null in revisits).

    Payloads are checked against their digests. A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    return files.select("content").mapInArrow(_read_batches, schema)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Archive the pages in the shared folder and list what the archives hold."""
    folder = f"{common.work_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder)
    held = read_archives(pages.sparkSession, folder)
    return held.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
