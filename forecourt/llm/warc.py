"""WARC archives in Zstandard: written from pages, read back record by record.

An archive begins with a skippable frame that holds the dictionary, and has one frame per record, so any record can be
decoded by itself. A page whose payload another page with a smaller id has is a revisit record without payload.

Archives are files in the shared folder, written by tasks through pyarrow's file systems under names of their own; the
manifest of a job names the files of the attempts that succeeded, so a lost executor leaves nothing that is read.
"""

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from .shared import binary_column, drawn, file_system, fixed, folder, put_file

MAGIC = 0x184D2A5D
#: Payload bytes from which an archive is closed; and what the dictionary is fitted on: pages, bytes of each, its size.
ARCHIVE_BYTES = 32 << 20
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 16 << 10, 64 << 10
LEVEL = 3
_DATE = "2026-01-01T00:00:00Z"


class DamagedArchive(ValueError):
    """An archive that breaks its own headers or lengths."""


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id):
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload, refers_to=None, revisit=False):
    """One WARC record: a response with its payload, or a revisit with the headers of what it would have held."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _uri(page_id)), ("WARC-Date", _DATE)]
    if url is not None:  # control characters would end the header
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _uri(refers_to)),
        ]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(data):
    """(headers, block) of one record; lengths and endings are checked."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise DamagedArchive("a record without version line or end of headers")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise DamagedArchive(f"a header without colon: {line[:80]}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise DamagedArchive(f"a record without {name}")
    size = headers["content-length"]
    if not size.isdigit() or len(rest) != int(size) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise DamagedArchive(f"a block of {len(rest) - 4} bytes where the header says {size}")
    return headers, rest[:-4]


def content(headers, block):
    """(page id, length of the full payload, its digest, record type, refers to, payload or None) of a parsed record."""
    http, found, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?i)\r\ncontent-length: (\d+)", http)
    if not found or not size:
        raise DamagedArchive("a block without HTTP headers")
    kind, said = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")

    def page(value):
        number = re.fullmatch(r"<urn:page:(-?\d*)>", value or "")
        if not number:
            raise DamagedArchive(f"no page id in {value}")
        return int(number[1]) if number[1] else None

    if kind == "response":
        if len(payload) != int(size[1]) or digest(payload) != said:
            raise DamagedArchive(f"{headers['warc-record-id']}: payload and digest disagree")
        return page(headers["warc-record-id"]), len(payload), said, kind, None, payload
    if kind != "revisit" or payload:
        raise DamagedArchive(f"a {kind} record with a payload of {len(payload)} bytes")
    return page(headers["warc-record-id"]), int(size[1]), said, kind, page(headers["warc-refers-to"]), None


class ArchiveWriter:
    """Collects the frames of one archive."""

    def __init__(self, dictionary):
        self.dictionary = dictionary
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True)
        self.frames, self.bytes, self.records = [struct.pack("<II", MAGIC, len(dictionary)) + dictionary], 0, 0

    def add(self, data):
        self.frames.append(self.compressor.compress(data))
        self.bytes, self.records = self.bytes + len(data), self.records + 1

    def data(self):
        return b"".join(self.frames)


def frames(data):
    """The contents of an archive's frames, one after the other."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != MAGIC:
        raise DamagedArchive("no leading dictionary frame")
    size = struct.unpack_from("<I", data, 4)[0]
    dictionary, at, view = data[8 : 8 + size], 8 + size, memoryview(data)
    if len(dictionary) != size:
        raise DamagedArchive("the dictionary is cut off")
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if size else None)
    while at < len(data):
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise DamagedArchive("the last frame is cut off")
            piece = view[at : at + (1 << 16)]
            parts.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def fit_dictionary(pages, id_col="page_id", html_col="html"):
    """A Zstandard dictionary from a bounded sample of pages, drawn by a hash of their ids; empty if they are too few."""
    sample = pages.select(F.substring(html_col, 1, SAMPLE_BYTES).alias("html"), F.xxhash64(id_col, html_col).alias("draw"))
    rows = drawn(sample.where("html is not null"), "draw", SAMPLE_PAGES).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r.html.encode() for r in rows]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


MANIFEST = "path string, records long"
CONTENT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def write_archives(pages, at=None, id_col="page_id", url_col="url", html_col="html", archive_bytes=ARCHIVE_BYTES):
    """Writes a record per page below the folder ``at``; returns the manifest (path, records).

    Of pages with equal payloads the one with the smallest id is the response (each row, if it repeats) and the others
    revisit it; a null id is larger than any other. A null html is an empty payload, a null url is left out. No pages
    give no archive; other columns are not looked at.
    """
    at = at or folder(pages.sparkSession, "warc")
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha2(html, 256).alias("same")
    )
    # Only payloads that occur twice or more are looked up: counted before the shuffle, one row each.
    shared = rows.groupBy("same").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    dictionary = fit_dictionary(pages, id_col, html_col)

    def write(batches):
        name, number, writer = uuid.uuid4().hex, 0, ArchiveWriter(dictionary)

        def close():
            path = f"{at}/{name}-{number:05d}.warc.zst"
            put_file(path, writer.data())
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([writer.records], pa.int64())], ["path", "records"])

        for batch in batches:
            payloads = binary_column(batch, "html")
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("page_id", "url", "first_id")]
            for page_id, url, first, payload in zip(*columns, payloads):
                revisit = first is not None and first != page_id
                writer.add(record(page_id, url, payload, first, revisit))
                if writer.bytes >= archive_bytes:
                    yield close()
                    number, writer = number + 1, ArchiveWriter(dictionary)
        if writer.records:
            yield close()

    return fixed(rows.join(shared, "same", "left").select("page_id", "url", "html", "first_id").mapInArrow(write, MANIFEST))


def read_archives(manifest, payloads=True):
    """Every record of the archives in a manifest, validated: CONTENT and, if asked for, the payload (binary).

    A record that breaks its headers, lengths or digest, and an archive with another number of records than the
    manifest says, stop the job with DamagedArchive.
    """

    def read(batches):
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = file_system(path)
                with store.open_input_stream(name, compression=None) as source:
                    data = source.read()
                seen, rows = 0, []
                for frame in frames(data):
                    found = content(*parse(frame))
                    rows.append(found if payloads else found[:-1])
                    seen += 1
                    if len(rows) == 256:
                        yield from _batch(rows)
                        rows = []
                if seen != records:
                    raise DamagedArchive(f"{path}: {seen} records instead of {records}")
                yield from _batch(rows)

    def _batch(rows):
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            names = CONTENT.replace(" long", "").replace(" string", "").split(", ") + ["payload"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names[: len(rows[0])])

    # The number is stated: by its size adaptive execution would leave the manifest to one task, which read every file.
    files = manifest.repartition(max(1, manifest.count()), "path")
    return files.mapInArrow(read, CONTENT + (", payload binary" if payloads else ""))
