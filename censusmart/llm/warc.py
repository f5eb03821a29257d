"""WARC archives compressed with Zstandard: one frame per record, a dictionary in the leading skippable frame.

Equal long payloads are stored once. The record with the largest page id is the response, the others are revisit
records that name it; a revisit's block holds the HTTP headers of the full payload, so its length and digest
can be read back. A task gathers records until a file is full, trains the file's dictionary on some of them, and hands
the file to Spark's writer. The reader loads the dictionary, decodes frame by frame, and validates versions, headers,
lengths and digests.

Defined cases: a null html is an empty payload; a null page id is kept as null and is never the response of
a group that has ids; rows that repeat the response's page id are responses too; a null url gives a record without a target
address; an empty table gives no files and no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusmart.llm.storage import read_files, saved, write_files

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 24 << 20
DICTIONARY_BYTES = 32 << 10
DICTIONARY_SAMPLES = 256
LEVEL = 3

# Fixed values of the formats: skippable frames, the dictionary's frame, the record version and profile.
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_DICTIONARY_FRAME = 0x184D2A5D
_FRAME = 0xFD2FB528
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page_id(record_id: str) -> int | None:
    if not (record_id.startswith("<urn:page:") and record_id.endswith(">")):
        raise ValueError(f"unknown record id {record_id!r}")
    number = record_id[10:-1]
    return None if number == "none" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes | None, length: int, digest: bytes, refers_to: int | None) -> bytes:
    """One WARC record; ``payload`` is None for a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"")
    headers = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", _DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~%")))
    if payload is None:
        headers += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", _PROFILE)]
    headers += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode()), ("WARC-Block-Digest", _sha1(block)),
                ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"".join([_VERSION, b"\r\n", *(f"{k}: {v}\r\n".encode() for k, v in headers), b"\r\n", block, b"\r\n\r\n"])


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("headers without an end")
    lines = head.split(b"\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(": ")
        if not colon:
            raise ValueError(f"not a header: {line[:80]!r}")
        fields[name.lower()] = value
    return {"": lines[0].decode()} | fields, rest


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, payload SHA-1 in hexadecimal, record type, page referred to) of a validated record."""
    fields, rest = _headers(data)
    if fields[""] != _VERSION.decode():
        raise ValueError(f"not a WARC record: {fields['']!r}")
    block, end = rest[:-4], rest[-4:]
    if end != b"\r\n\r\n" or len(block) != int(fields["content-length"]):
        raise ValueError("record length and Content-Length disagree")
    if _sha1(block) != fields["warc-block-digest"]:
        raise ValueError("block digest is wrong")
    http, payload = _headers(block)
    if not http[""].startswith("HTTP/1."):
        raise ValueError("block is no HTTP response")
    length, kind = int(http["content-length"]), fields["warc-type"]
    if kind == "response":
        if len(payload) != length or _sha1(payload) != fields["warc-payload-digest"]:
            raise ValueError("payload length or digest is wrong")
    elif kind != "revisit" or payload:
        raise ValueError(f"record type {kind!r} or its payload is wrong")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    return _page_id(fields["warc-record-id"]), length, digest, kind, _page_id(fields["warc-refers-to"]) if kind == "revisit" else None


def archive(records: list[bytes]) -> bytes:
    """One archive file. Its dictionary is trained on records spread over the file; few or odd records give none."""
    dictionary, head = None, b""
    step = max(1, len(records) // DICTIONARY_SAMPLES)
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, records[::step])
        stored = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
        head = _DICTIONARY_FRAME.to_bytes(4, "little") + len(stored).to_bytes(4, "little") + stored
    except zstandard.ZstdError:
        dictionary, head = None, b""
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True, write_content_size=True)
    return b"".join([head, *map(packer.compress, records)])


def records_of(content: bytes) -> Iterator[bytes]:
    """The records of an archive file, decoded frame by frame."""
    view, at, unpacker = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        magic = int.from_bytes(view[at:at + 4], "little")
        if magic in _SKIPPABLE:
            size = int.from_bytes(view[at + 4:at + 8], "little")
            body = bytes(view[at + 8:at + 8 + size])
            if len(body) != size:
                raise ValueError("the file ends within a skippable frame")
            if magic == _DICTIONARY_FRAME and at == 0:
                if int.from_bytes(body[:4], "little") == _FRAME:
                    body = zstandard.ZstdDecompressor().decompress(body)
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
            continue
        if magic != _FRAME:
            raise ValueError(f"no frame at byte {at}")
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if at >= len(view):
                raise ValueError("the file ends within a frame")
            piece = view[at:at + 16384]
            parts.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def write_archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Write a record per page; returns the folder of the archive files."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    base = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    base = base.withColumn("length", F.length("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    # Only groups of several records are joined back, so unique pages pass a small table or none.
    groups = saved(base.where(F.col("length") >= MIN_REVISIT_BYTES).groupBy("digest")
                   .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n"), "responses")
    placed = base.join(groups, "digest", "left")
    revisit = (F.col("length") >= MIN_REVISIT_BYTES) & F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    rows = placed.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "length", "digest",
                         F.when(revisit, F.col("response")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([archive(held)], pa.binary())], names=["content"])

        for batch in batches:
            for row in zip(*batch.columns):
                held.append(record(*(value.as_py() for value in row)))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield file()
                    held, size = [], 0
        if held:
            yield file()

    return write_files(rows.mapInArrow(run, "content binary"), "warc")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record in a folder of archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [parse(r) for r in records_of(content.as_py())]
                columns = list(zip(*rows)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return read_files(spark, folder).select("content").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
