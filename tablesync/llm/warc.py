"""WARC archives with a Zstandard dictionary, written and read by Spark tasks.

An archive is a ``.warc.zst`` stream: a skippable frame that holds a dictionary trained on
the archive's own first records, then one frame per record. Spark's text writer stores each
archive as a file of its own: an archive is one row, taken as the bytes it is, and the line
separator after it is an empty skippable frame, which readers pass over. So the job's commit
protocol and any file system Spark can write to apply.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 16 << 10
#: Bytes of records that an archive's dictionary is trained on.
TRAINING_BYTES = 1 << 20
LEVEL = 3


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _one_line(value) -> str:
    return "" if value is None else " ".join(str(value).split())


def make_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date) -> bytes:
    """A response with its payload, or a revisit with the response's HTTP head only."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Page-ID", _one_line(page_id)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("Refers-To-Page-ID", _one_line(refers_to)),
        ]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """The named fields (lower-cased names) and the block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, rest[: int(fields["content-length"])]


def train(records: list[bytes]):
    """A dictionary for records like these; raw content when they are too few to train on."""
    import zstandard

    samples = [one[i : i + 2048] for one in records for i in range(0, len(one), 2048)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=200, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(records)[:DICTIONARY_BYTES])


def write_frames(records: Iterator[bytes], limit: int) -> Iterator[bytes]:
    """Archives of the records, each of about ``limit`` compressed bytes."""
    import zstandard

    def opened(held: list[bytes]):
        dictionary = train(held)
        own = dictionary.as_bytes()
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        frames = [struct.pack("<II", DICTIONARY_MAGIC, len(own)) + own]
        return compressor, frames + [compressor.compress(one) for one in held]

    held: list[bytes] = []
    waiting = size = 0
    compressor = None
    for record in records:
        if compressor is None:
            held.append(record)
            waiting += len(record)
            if waiting < TRAINING_BYTES:
                continue
            compressor, frames = opened(held)
            size, held, waiting = sum(map(len, frames)), [], 0
        else:
            frames.append(compressor.compress(record))
            size += len(frames[-1])
        if size >= limit:
            yield b"".join(frames)
            compressor = None
    if compressor is None and held:
        compressor, frames = opened(held)
    if compressor is not None:
        yield b"".join(frames)


def read_frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive, decompressed one by one."""
    import zstandard

    dictionary, at = None, 0
    decompressor = zstandard.ZstdDecompressor()
    while at < len(data):
        (magic,) = struct.unpack_from("<I", data, at)
        if magic in SKIPPABLE:
            (size,) = struct.unpack_from("<I", data, at + 4)
            if magic == DICTIONARY_MAGIC and dictionary is None:
                dictionary = zstandard.ZstdCompressionDict(data[at + 8 : at + 8 + size])
                decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
            continue
        end = at + zstandard.frame_header_size(data[at : at + 18])
        last = False
        while not last:  # block headers: last flag, kind, size
            block = int.from_bytes(data[end : end + 3], "little")
            last, kind = bool(block & 1), block >> 1 & 3
            end += 3 + (1 if kind == 1 else block >> 3)
        end += 4 if data[at + 4] & 4 else 0  # checksum
        yield decompressor.decompress(data[at:end])
        at = end


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, refers_to, revisit`` of every page.

    Of pages with equal payloads of at least ``least_bytes`` the one with the largest id is
    the response and the others revisit it. A null payload is empty. Rows that repeat the
    response's id are responses too, and so are pages whose group has only null ids.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = pages.select("page_id", "url", payload.alias("payload"))
    full = full.withColumn("digest", F.sha1("payload"))
    keys = full.where(F.length("payload") >= least_bytes).select("page_id", "digest")
    groups = keys.groupBy("digest").agg(
        F.max("page_id").alias("latest"), F.count("*").alias("n")
    )
    groups = groups.where((F.col("n") > 1) & F.col("latest").isNotNull())
    # Only ids and digests meet a group, so a hot payload moves nothing but those.
    later = keys.join(groups.select("digest", "latest"), "digest")
    later = later.where(~F.col("page_id").eqNullSafe(F.col("latest"))).distinct()
    later = later.select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"),
        F.col("latest").alias("refers_to"),
    )
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    return full.join(later, same, "left").select(
        "page_id", "url", "payload", "digest", "refers_to",
        F.col("refers_to").isNotNull().alias("revisit"),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    least_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Archive ``pages`` (``page_id, url, html``) below ``path``, one file per archive.

    Files hold about ``archive_bytes`` compressed bytes, more only for a single record that
    is larger. An empty table writes no archive.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                columns = [
                    batch.column(name)
                    for name in ("page_id", "url", "payload", "digest", "refers_to", "revisit")
                ]
                for row in zip(*columns):
                    page, url, payload, digest, refers_to, revisit = (x.as_py() for x in row)
                    name = base64.b32encode(bytes.fromhex(digest)).decode()
                    yield make_record(page, url, payload, name, refers_to, revisit, date)

        for archive in write_frames(records(), archive_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], ["archive"])

    archives = plan_records(pages, least_bytes).mapInArrow(task, "archive binary")
    archives.select(F.col("archive").cast("string")).write.options(
        lineSep=EMPTY_FRAME.decode(), compression="none", maxRecordsPerFile=1
    ).text(path)


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Every response and revisit: ``page_id, url, payload, payload_bytes, payload_digest,
    record_type, refers_to``.

    The payload, its length and digest come from the bytes stored for a response; a revisit
    has no payload, and the length and digest of the response's.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type",
                 "refers_to"]
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(),
                 pa.string()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names
            )

        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for record in read_frames(content.as_py()):
                    fields, block = parse_record(record)
                    kind = fields.get("warc-type")
                    if kind not in ("response", "revisit"):
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    if kind == "response":
                        length, digest = len(payload), digest_of(payload)
                    else:
                        payload = None
                        length = int(head.lower().partition(b"content-length:")[2].split()[0])
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    rows.append(
                        (fields.get("page-id") or None, fields.get("warc-target-uri"), payload,
                         length, digest, kind, fields.get("refers-to-page-id") or None)
                    )
                    size += len(payload or b"") + 256
                    if size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    found = spark.read.format("binaryFile").load(path).select("content")
    found = found.mapInArrow(
        task,
        "page_id string, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to string",
    )
    return found.withColumns(
        {name: F.col(name).cast(id_type) for name in ("page_id", "refers_to")}
    )


def archive_round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` to archives below ``path`` and describe what they read back as."""
    write_archives(pages, path)
    kind = dict(pages.dtypes)["page_id"]
    if pages.isEmpty():
        return read_archives(pages.sparkSession, path, kind).drop("payload", "url").limit(0)
    return read_archives(pages.sparkSession, path, kind).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
