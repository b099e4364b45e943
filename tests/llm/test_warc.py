from __future__ import annotations

import base64
import glob
import hashlib
import io
import struct
from collections import defaultdict

import pytest

from tablesync.llm.warc import (
    DICTIONARY_MAGIC, EMPTY_FRAME, archive_round_trip, parse_record, read_archives, read_frames,
    write_archives, write_frames,
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(pages, least=0):
    groups = defaultdict(list)
    for page in pages:
        groups[page.html or ""].append(page.page_id)
    out = []
    for page in pages:
        data = (page.html or "").encode()
        last = max((p for p in groups[page.html or ""] if p is not None), default=None)
        response = last is None or page.page_id == last or len(data) < least
        kind, to = ("response", None) if response else ("revisit", last)
        out.append((page.page_id, len(data), digest(data), kind, to))
    return sorted(out, key=str)


def test_pages_round_trip(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = archive_round_trip(pages, str(tmp_path / "w"))
    assert sorted(map(tuple, found.collect()), key=str) == expected(pages.collect())


@pytest.fixture
def odd_pages(rows):
    return rows(
        "page_id long, url string, html string, digest string, n long",
        (1, None, None, "x", 1), (2, "http://a/\r\nWARC-Type: evil", "", "x", 1),
        (3, "u", "<p>é\r\n\r\n</p>", None, None), (4, "u", "<p>é\r\n\r\n</p>", None, None),
        (4, "u", "<p>é\r\n\r\n</p>", None, None), (None, "u", "only", None, None),
        (6, "u", "long " * 200_000, None, None), (7, "u", "WARC/1.1\r\n", None, None),
    )


def test_awkward_pages(odd_pages, tmp_path):
    found = archive_round_trip(odd_pages, str(tmp_path / "w"))
    assert sorted(map(tuple, found.collect()), key=str) == expected(odd_pages.collect())
    assert archive_round_trip(odd_pages.limit(0), str(tmp_path / "e")).count() == 0


def test_payloads_and_least_bytes(spark, odd_pages, tmp_path):
    write_archives(odd_pages, str(tmp_path / "w"), least_bytes=5)
    found = read_archives(spark, str(tmp_path / "w")).collect()
    html = {r.page_id: (r.html or "").encode() for r in odd_pages.collect()}
    for row in found:
        if row.record_type == "response":
            assert bytes(row.payload) == html[row.page_id]
    kinds = sorted((r.page_id or 0, r.record_type) for r in found)
    assert (1, "response") in kinds and (2, "response") in kinds and (3, "revisit") in kinds


def test_archives_are_plain_zstandard_streams(odd_pages, tmp_path):
    import zstandard

    write_archives(odd_pages, str(tmp_path / "w"), archive_bytes=1000)
    files = [open(f, "rb").read() for f in glob.glob(str(tmp_path / "w" / "part-*"))]
    assert files
    for data in files:
        magic, size = struct.unpack_from("<II", data)
        assert magic == DICTIONARY_MAGIC
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(
            io.BytesIO(data[8 + size :]), read_across_frames=True
        )
        assert reader.read() == b"".join(read_frames(data))


def test_a_trained_dictionary_helps_and_large_records_fit():
    records = [f"<html><title>{i}</title>common words here {i % 7}</html>".encode() * 3 for i in range(9000)]
    archives = list(write_frames(iter(records), 100_000))
    assert len(archives) > 1
    assert [r for a in archives for r in read_frames(a)] == records
    import zstandard

    plain = sum(len(zstandard.ZstdCompressor(3).compress(r)) for r in records)
    assert sum(map(len, archives)) < plain
    assert list(read_frames(archives[0] + EMPTY_FRAME)) == list(read_frames(archives[0]))


def test_records_parse():
    from tablesync.llm.warc import make_record

    record = make_record(5, "u", b"a\r\n\r\nb", digest(b"a\r\n\r\nb"), None, False, "2020-01-01T00:00:00Z")
    fields, block = parse_record(record)
    assert fields["warc-type"] == "response" and fields["page-id"] == "5"
    assert block.endswith(b"\r\n\r\na\r\n\r\nb")
