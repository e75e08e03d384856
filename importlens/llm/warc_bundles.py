"""WARC archives in seekable Zstandard bundles.

Each task appends its records to bundle files in the shared folder. Records are
grouped into frames of about ``FRAME_BYTES`` that decompress on their own; a
bundle ends with a skippable frame that holds the seek table (compressed and
plain size of every frame) and its footer, so any Zstandard reader also reads
the bundle from start to end. The written index maps a record's identifier to
its bundle, frame, offset in the plain frame, and length.

A bundle's name is unique to the attempt, and only the index of committed tasks
names bundles: a lost executor or a repeated task leaves at most unnamed files.

Records with equal payloads of at least ``min_bytes`` bytes: the one with the
smallest identifier is a response, the others revisit it and store no payload.

Defined results: a null payload is empty; a null address is an empty one. Rows
that repeat the smallest identifier of their payload are responses each. A null
identifier is kept; it is never the smallest unless all are null. Extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from typing import BinaryIO, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.llm.common import arrow_pass, counted_broadcast, shared_uri, table, written
from importlens.session import work_dir

FRAME_BYTES, BUNDLE_BYTES, LEVEL, MIN_BYTES = 1 << 18, 1 << 26, 3, 0
DATE = "1970-01-01T00:00:00Z"    # pages carry no date
#: Magic numbers of the public seekable format.
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id long, bundle string, frame int, offset long, length long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the response's head only."""
    kind = "response" if refers_to is None else "revisit"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~' + chr(39))}",
             f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(plain: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and end of the record that starts at ``at``."""
    end = plain.index(b"\r\n\r\n", at)
    version, *lines = plain[at:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record starts at {at}")
    fields = dict(x.split(": ", 1) for x in lines)
    start = end + 4
    stop = start + int(fields["Content-Length"])
    return fields, plain[start:stop], stop + 4


class BundleWriter:
    """Appends records to one bundle; knows where each one begins."""

    def __init__(self, out: BinaryIO, frame_bytes: int = FRAME_BYTES):
        self.out, self.limit, self.frames = out, frame_bytes, []
        self.buffer, self.written = bytearray(), 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, data: bytes) -> tuple[int, int, int]:
        """Frame, offset in the plain frame, and length of the record."""
        if self.buffer and len(self.buffer) + len(data) > self.limit:
            self._flush()
        place = len(self.frames), len(self.buffer), len(data)
        self.buffer += data
        return place

    def _flush(self) -> None:
        packed = self.packer.compress(bytes(self.buffer))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.buffer)))
        self.written += len(packed)
        self.buffer = bytearray()

    def close(self) -> None:
        if self.buffer:
            self._flush()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries
                       + struct.pack("<IBI", len(self.frames), 0, FOOTER))
        self.out.close()


class BundleReader:
    """Random access to the frames of one bundle through its seek table."""

    def __init__(self, source):
        self.source, size = source, source.size()
        number, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != FOOTER or flags:
            raise ValueError("no seek table")
        table_bytes = source.read_at(8 * number, size - 9 - 8 * number)
        self.sizes = list(struct.iter_unpack("<II", table_bytes))
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)

    def frame(self, k: int) -> bytes:
        packed, plain = self.sizes[k]
        return zstandard.ZstdDecompressor().decompress(self.source.read_at(packed, self.starts[k]), max_output_size=plain)

    def __len__(self) -> int:
        return len(self.sizes)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (see ``common.shared_uri``)."""
    return pafs.FileSystem.from_uri(path)


def _write_task(batches: Iterator[pa.RecordBatch], folder: str, frame_bytes: int, bundle_bytes: int) -> Iterator[pa.RecordBatch]:
    files, base = _opened(folder)
    files.create_dir(base, recursive=True)
    writer, rows, name = None, [], ""

    def index() -> pa.RecordBatch:
        columns = [pa.array([r[c] for r in rows], pa.string() if c == 1 else pa.int32() if c == 2 else pa.int64()) for c in range(5)]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "bundle", "frame", "offset", "length"])

    for batch in batches:
        for page_id, url, html, first in zip(*[batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to")]):
            if writer is None:
                name = f"{uuid.uuid4().hex}.warc.zst"
                writer, rows = BundleWriter(files.open_output_stream(f"{base}/{name}", compression=None), frame_bytes), []
            payload = (html or "").encode("utf-8", "surrogatepass")
            rows.append((page_id, f"{folder}/{name}", *writer.add(record(page_id, url, payload, first))))
            if writer.written >= bundle_bytes:
                writer.close()
                yield index()
                writer = None
    if writer is not None:
        writer.close()
        yield index()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, frame_bytes: int = FRAME_BYTES,
                   bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record for every row of ``pages`` (``page_id, url, html``) into ``folder``; returns the written index."""
    folder = shared_uri(pages.sparkSession, folder)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    sha = F.unhex(F.sha1(F.col("html").cast("binary"))).alias("sha")
    large = rows.where(F.octet_length("html") >= min_bytes).select("page_id", sha)
    firsts = large.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = written(firsts.select(F.col("sha").alias("same"), "first"), "warc-repeated")
    own = rows.select("*", sha)
    found = own.join(counted_broadcast(firsts), (F.col("sha") == F.col("same")) & (F.octet_length("html") >= min_bytes), "left")
    found = found.select("page_id", "url", "html", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))
    return written(found.mapInArrow(lambda b: _write_task(b, folder, frame_bytes, bundle_bytes), INDEX), "warc-index")


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["bundle"].to_pylist():
            files, name = _opened(path)
            with files.open_input_file(name) as source:
                reader = BundleReader(source)
                for k in range(len(reader)):
                    yield _described(reader.frame(k))


def _described(plain: bytes) -> pa.RecordBatch:
    """What the records of one frame say; the digest and size of a response are taken from its payload."""
    at, rows = 0, []
    while at < len(plain):
        fields, block, at = parse(plain, at)
        head, _, payload = block.partition(b"\r\n\r\n")
        if fields["WARC-Type"] == "response":
            size, digest = len(payload), base32_sha1(payload)
        else:
            size = int(re.search(rb"Content-Length: (\d+)", head)[1])
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        refers = fields.get("WARC-Refers-To")
        rows.append((_number(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers and _number(refers)))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names)


def read_archives(index: DataFrame) -> DataFrame:
    """Rows ``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of all bundles that ``index`` names."""
    bundles = written(index.select("bundle").distinct(), "warc-bundles")
    # a task for each bundle: the names alone are so small that they would end in one task
    return bundles.repartition(max(1, bundles.count())).mapInArrow(_read_task, "page_id long, payload_bytes long, payload_digest string, "
                                          "record_type string, refers_to long")


def fetch(index: DataFrame) -> DataFrame:
    """Rows ``(page_id, record)`` for the rows of ``index`` (some of a written index): only their frames are read."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, last, frame, plain = [], None, None, b""
        for path, k, offset, length in zip(*[batch[c].to_pylist() for c in ("bundle", "frame", "offset", "length")]):
            if (path, k) != (last, frame):
                files, name = _opened(path)
                with files.open_input_file(name) as source:
                    last, frame, plain = path, k, BundleReader(source).frame(k)
            out.append(plain[offset:offset + length])
        return pa.RecordBatch.from_arrays([batch["page_id"], pa.array(out, pa.binary())], ["page_id", "record"])

    return arrow_pass(index, step, "page_id long, record binary")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the bundles."""
    return read_archives(write_archives(table(spark, sf_dir, "pages"), work_dir(spark, "warc")))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31))::INTEGER, 1)), '')
    AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p JOIN f USING (h)
"""
