"""Archives: exact round trip, any Zstandard reader, random access."""

import base64
import hashlib
import io

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from importlens.llm import warc_bundles as wb
from importlens.session import work_dir

SCHEMA = "page_id long, url string, html string, refers_to string"
ROWS = [(1, "http://a/1?q=ü x", "<p>é</p>", "x"), (2, "http://a/2", "<p>é</p>", None), (3, None, None, "x"), (4, "", "", "x"),
        (5, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb", "x"), (6, "u", "long " * 300_000, "x"), (7, "u", "<p>é</p>", "x"),
        (8, "u", "once", "x"), (8, "u", "once", "x"), (None, "u", "<p>é</p>", "x"), (9, "u\r\nX: y", "z", "x")]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html, _ in rows:
        raw = html or ""
        other = first.get(raw) if len(raw.encode()) >= min_bytes and first.get(raw) != i else None
        out.append((i, len(raw.encode()), digest(raw), "response" if other is None else "revisit", other))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, min_bytes):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    index = wb.write_archives(pages, work_dir(spark, "t"), min_bytes=min_bytes, frame_bytes=1000, bundle_bytes=200)
    got = sorted((tuple(r) for r in wb.read_archives(index).collect()), key=str)
    assert got == expected(ROWS, min_bytes)
    assert index.count() == len(ROWS)


def test_records_are_fetched_by_identifier(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    index = wb.write_archives(pages, work_dir(spark, "t"), frame_bytes=500)
    got = {r.page_id: wb.parse(bytes(r.record)) for r in wb.fetch(index.where(F.col("page_id").isin(2, 5, 6))).collect()}
    assert sorted(got) == [2, 5, 6]
    assert got[2][0]["WARC-Refers-To"] == "<urn:page:1>"
    for i in (5, 6):
        assert got[i][1].partition(b"\r\n\r\n")[2].decode() == ROWS[i - 1][2]


def test_bundles_are_plain_zstandard_too(tmp_path):
    path = str(tmp_path / "b.zst")
    records = [wb.record(i, "u", b"x" * i, None) for i in range(100)]
    writer = wb.BundleWriter(open(path, "wb"), frame_bytes=700)
    places = [writer.add(r) for r in records]
    writer.close()
    with zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True) as plain:
        assert io.BufferedReader(plain).read() == b"".join(records)
    with pa.OSFile(path, "rb") as source:
        reader = wb.BundleReader(source)
        assert len(reader) > 10
        for (frame, offset, length), r in zip(places, records):
            assert reader.frame(frame)[offset:offset + length] == r


def test_empty_table(spark):
    index = wb.write_archives(spark.createDataFrame([], SCHEMA), work_dir(spark, "t"))
    assert index.collect() == [] and wb.read_archives(index).collect() == []
