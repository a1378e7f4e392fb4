"""WARC archives: one gzip member per record, written by tasks and read back sequentially."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.operators.layout import scratch_path, stored

# An archive is closed once it holds this many bytes; it is read as one row, so this bounds a reader's row.
ARCHIVE_BYTES = 16 << 20
READ_BYTES = 1 << 16
# The manifest rows of so many tasks make one file. Every file starts processes where Hadoop sets its mode by chmod.
TASKS_PER_FILE = 64
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
GZIP_LEVEL = 4


def base32_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line: control characters and % as %XX."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def _unclean(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record as a gzip member.

    A response holds the HTTP head and the payload; a revisit the head only, whose Content-Length still tells
    the payload's size.
    """
    digest = base32_digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}/{url}/{digest}")
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if revisit:
        fields.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            fields.append(("Refers-To-Page-Id", str(refers_to)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_digest(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _store(target: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = pafs.FileSystem.from_uri(target)
        attempt, out, path, size, number = uuid.uuid4().hex, None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([number], pa.int64()), pa.array([size], pa.int64())],
                                              ["file", "records", "bytes"])

        for batch in batches:
            columns = [batch.column(j) for j in range(5)]
            for page_id, url, html, refers_to, revisit in zip(*columns):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                member = record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), revisit.as_py())
                if out is not None and size + len(member) > archive_bytes:
                    yield closed()
                    out = None
                if out is None:
                    path, size, number = f"archive-{uuid.uuid5(uuid.NAMESPACE_OID, attempt + str(size) + path)}.warc.gz", 0, 0
                    files.create_dir(folder, recursive=True)
                    out = files.open_output_stream(f"{folder}/{path}", compression=None)
                out.write(member)
                size, number = size + len(member), number + 1
        if out is not None:
            yield closed()
    return run


def write_archives(pages: DataFrame, folder: str, min_payload: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html); returns the manifest (file, records, bytes).

    Of rows with equal payloads (SHA-1) of at least ``min_payload`` bytes, those with the largest page_id
    become responses and all others revisits of it; shorter payloads are all responses. Null html is an empty
    payload; a null page_id is smaller than any other. Rows with the same page_id and payload are alike.

    Tasks write under names of their own attempt. Only files in the manifest count, so that a task run
    twice, or an executor lost halfway, adds nothing. ``folder`` is a URI that all executors reach.
    """
    text = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
                        F.sha1(text.cast("binary")).alias("digest"), F.octet_length(text).alias("size"))
    # The largest page of a payload: ids and digests only, combined before the shuffle.
    groups = rows.filter(F.col("size") >= min_payload).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    groups = groups.filter("rows > 1").select("digest", "first")
    rows = rows.join(groups, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("size") >= min_payload)
    rows = rows.select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))
    listed = rows.mapInArrow(_store(folder, archive_bytes), "file string, records long, bytes long")
    # All rows of a task go to one reader, which takes them from one attempt, though a second one has other names.
    return stored(listed.repartition(F.floor(F.spark_partition_id() / TASKS_PER_FILE)), "manifest")


class _Stream:
    """The decompressed bytes of a gzip file of many members, a little at a time."""

    def __init__(self, data: memoryview):
        self.data, self.at, self.buffer = data, 0, bytearray()
        self.unpacker = zlib.decompressobj(31)
        self.ended = False  # at the end of a member

    def _more(self) -> bool:
        while self.at < len(self.data):
            if self.unpacker.eof:
                self.unpacker = zlib.decompressobj(31)
            piece = self.data[self.at : self.at + READ_BYTES]
            out = self.unpacker.decompress(piece, 1 << 20)
            self.at += len(piece) - len(self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail)
            if out:
                self.buffer += out
                return True
        return False

    def until(self, mark: bytes, limit: int = 1 << 20) -> bytes | None:
        """Up to and with the mark; None at the end of the file."""
        seen = 0
        while (found := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if seen > limit or not self._more():
                if self.buffer:
                    raise ValueError("a record head does not end")
                return None
        head = bytes(self.buffer[: found + len(mark)])
        del self.buffer[: found + len(mark)]
        return head

    def exactly(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self._more():
                raise ValueError("the file ends within a record")
        block = bytes(self.buffer[:size])
        del self.buffer[:size]
        return block


def records(data: memoryview) -> Iterator[dict]:
    """The records of an archive, one after the other; raises where framing or a digest is wrong."""
    stream = _Stream(data)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        version, *lines = head[:-4].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = stream.exactly(int(fields["Content-Length"]))
        if stream.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        if fields.get("WARC-Block-Digest") not in (None, "sha1:" + base32_digest(block)):
            raise ValueError(f"block digest of {fields.get('WARC-Record-ID')}")
        http, _, payload = block.partition(b"\r\n\r\n")
        told = re.search(rb"(?im)^content-length: *(\d+)", http)
        revisit = fields["WARC-Type"] == "revisit"
        if not revisit and "WARC-Payload-Digest" in fields and fields["WARC-Payload-Digest"] != "sha1:" + base32_digest(payload):
            raise ValueError(f"payload digest of {fields.get('WARC-Record-ID')}")
        number = lambda name: int(fields[name]) if name in fields else None
        yield {
            "page_id": number("Page-Id"), "url": _unclean(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
            "record_type": fields["WARC-Type"], "refers_to": number("Refers-To-Page-Id"),
            "payload_digest": fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
            "payload_bytes": int(told[1]) if revisit and told else len(payload), "payload": None if revisit else payload}


RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
_RECORD_DDL = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def _parsed(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in records(memoryview(content.as_buffer())):
                    row["payload"] = row["payload"] if with_payload else None
                    rows.append(row)
                    size += row["payload_bytes"]
                    if size > 4 << 20 or len(rows) >= 5_000:
                        yield pa.RecordBatch.from_pylist(rows, RECORD)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, RECORD)
    return run


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame | None = None, with_payload: bool = True) -> DataFrame:
    """The records of all ``*.warc.gz`` in a folder that Spark can read, or of those in the manifest.

    Each file is one row, decompressed a little at a time: header lines, then exactly Content-Length bytes.
    Block digests, and payload digests of responses, are verified; a damaged file raises. A revisit has no
    payload; its size comes from the HTTP head it holds. No file gives an empty table.
    """
    if manifest is not None and manifest.isEmpty():
        return spark.createDataFrame([], _RECORD_DDL)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    if manifest is not None:
        files = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(manifest.select("file"), "file", "left_semi")
    return files.select("content").mapInArrow(_parsed(with_payload), _RECORD_DDL)


def archived(pages: DataFrame, min_payload: int = 0, with_payload: bool = True) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back."""
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder:  # file:/path or a bare path: the form that Arrow's file systems take
        folder = "file://" + folder.removeprefix("file:")
    manifest = write_archives(pages, folder, min_payload)
    return read_archives(pages.sparkSession, folder, manifest, with_payload)
