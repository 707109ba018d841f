"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that are compressed independently; a bundle
is a run of frames followed by a skippable frame with the seek table (the
compressed and plain size of every frame, and a footer), so any Zstandard tool
reads the whole and a reader can seek. The index maps a record id to (bundle,
frame, offset in the plain frame, length), and :func:`fetch` decompresses only
the frames it needs.

Bundles are rows of a Parquet table (``bundle``, ``data`` and the index
arrays): Spark commits them, on any store it can write, and a lost executor's
tasks are run again. :func:`export` says how to copy them out as files.

Deduplication: of records with equal payloads of at least ``MIN_REVISIT``
bytes the one with the largest id is a ``response``; the others are
``revisit`` records without a body that refer to it.

Cases: a null payload is empty; a null url leaves out the header; a null id is
written as an empty id and read back as null (it never is the response of a
group that has an id); rows that repeat the largest id are responses all;
control characters in urls are percent-encoded; a frame holds at least one
record however long; an empty table gives no bundles.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow, pick, rows_in, Scratch

MIN_REVISIT = 1000
FRAME_BYTES = 256 << 10  # plain bytes that close a frame
BUNDLE_BYTES = 8 << 20  # compressed bytes that close a bundle
LEVEL = 3
ROWS_AT_A_TIME = 256

# Fixed values of the seekable Zstandard format and of WARC 1.1.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame with (compressed, plain) sizes of the frames before it."""
    body = b"".join(struct.pack("<II", c, p) for c, p in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the footer."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    at, out = len(data) - 9 - count * width, []
    start = 0
    for k in range(count):
        c, p = struct.unpack_from("<II", data, at + k * width)
        out.append((start, c, p))
        start += c
    return out


def _header_value(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False, date: str = NO_DATE) -> bytes:
    """One WARC record; a revisit has the payload's digest and length only."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = "" if page_id is None else page_id
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(plain: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """(WARC headers, block, where the next record begins)."""
    end = plain.index(b"\r\n\r\n", at)
    first, *lines = plain[at:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines)
    size = int(headers["Content-Length"])
    return headers, plain[end + 4:end + 4 + size], end + 4 + size + 4


def _urn(value: str | None):
    name = value[len("<urn:page:"):-1] if value else ""
    return int(name) if name else None


def described(headers: dict, block: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload)
    of a parsed record; a response's payload is held against its digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not fit its headers")
    return _urn(headers["WARC-Record-ID"]), size, digest, kind, _urn(headers.get("WARC-Refers-To")), payload


BUNDLE_SCHEMA = "bundle string, data binary, record_ids array<long>, frames array<int>, offsets array<long>, lengths array<long>"


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    made = 0
    frame, done, sizes, index = bytearray(), [], [], []

    def close_frame():
        if frame:
            done.append(pack.compress(bytes(frame)))
            sizes.append((len(done[-1]), len(frame)))
            frame.clear()

    def close_bundle():
        nonlocal made
        ids, frames, offsets, lengths = (list(x) for x in zip(*index))
        data = b"".join(done) + seek_table(sizes)
        out = pa.RecordBatch.from_arrays(
            [pa.array([f"bundle-{part:06d}-{made:06d}"]), pa.array([data], pa.binary()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([frames], pa.list_(pa.int32())), pa.array([offsets], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64()))],
            names=["bundle", "data", "record_ids", "frames", "offsets", "lengths"])
        made += 1
        done.clear(), sizes.clear(), index.clear()
        return out

    held = 0
    for batch in rows_in(batches, ROWS_AT_A_TIME):
        for page_id, url, payload, refers_to, revisit in zip(*[c.to_pylist() for c in batch.columns]):
            raw = record(page_id, url, payload or b"", refers_to, revisit)
            index.append((page_id, len(done), len(frame), len(raw)))
            frame += raw
            if len(frame) >= FRAME_BYTES:
                close_frame()
                held += sizes[-1][0]
                if held >= BUNDLE_BYTES:
                    yield close_bundle()
                    held = 0
    close_frame()
    if index:
        yield close_bundle()


def build(pages: DataFrame, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Bundles of one record per page, written and read back as a table."""
    source = pick(pages, id_col, url_col, payload_col).toDF("_id", "_url", "_html").select(
        F.col("_id").cast("long").alias("_id"), F.col("_url").cast("string").alias("_url"),
        F.coalesce(F.col("_html").cast("string"), F.lit("")).cast("binary").alias("_body"))
    long_enough = F.octet_length("_body") >= MIN_REVISIT
    keyed = source.withColumn("_sum", F.when(long_enough, F.sha2("_body", 256)))
    groups = keyed.filter("_sum is not null").groupBy("_sum").agg(F.max("_id").alias("_keeper"), F.count(F.lit(1)).alias("_n"))
    keepers = scratch.write(groups.filter("_n > 1 and _keeper is not null").select(F.col("_sum").alias("_same"), "_keeper"), "keepers")
    revisit = F.col("_keeper").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keeper"))
    records = keyed.join(keepers, F.col("_sum") == F.col("_same"), "left").select(
        "_id", "_url", "_body", "_keeper", revisit.alias("_revisit"))
    return scratch.write(map_arrow(records, _bundles, BUNDLE_SCHEMA), "bundles")


def index(bundles: DataFrame) -> DataFrame:
    """(record_id, bundle, frame, offset, length): reads no bundle's data."""
    zipped = F.explode(F.arrays_zip("record_ids", "frames", "offsets", "lengths")).alias("r")
    return bundles.select("bundle", zipped).select(
        F.col("r.record_ids").alias("record_id"), "bundle", F.col("r.frames").alias("frame"),
        F.col("r.offsets").alias("offset"), F.col("r.lengths").alias("length"))


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, a frame at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in rows_in(batches, 1):
            data = batch.column(0)[0].as_py()
            for start, size, length in frames_of(data):
                plain = unpack.decompress(data[start:start + size], max_output_size=length)
                rows, at = [], 0
                while at < len(plain):
                    headers, block, at = parse(plain, at)
                    rows.append(described(headers, block)[:5])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ)], schema=_READ)

    return map_arrow(bundles.select("data"), run, READ_SCHEMA)


def fetch(bundles: DataFrame, wanted: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The records (with payload) of the wanted ids by the index: only the
    frames that hold them are decompressed."""
    ids = pick(wanted, id_col).toDF("record_id").filter("record_id is not null").distinct()
    at = index(bundles).join(ids, "record_id").groupBy("bundle").agg(F.collect_list(F.struct("frame", "offset")).alias("at"))
    schema = READ_SCHEMA + ", payload binary"
    arrow = pa.schema([*_READ, ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in rows_in(batches, 1):
            data, places = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            frames, plain, shown = frames_of(data), b"", None
            for place in sorted(places, key=lambda p: (p["frame"], p["offset"])):
                if place["frame"] != shown:
                    shown = place["frame"]
                    start, size, length = frames[shown]
                    plain = unpack.decompress(data[start:start + size], max_output_size=length)
                row = described(*parse(plain, place["offset"])[:2])
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

    return map_arrow(bundles.select("bundle", "data").join(at, "bundle").select("data", "at"), run, schema)


def export(bundles: DataFrame) -> DataFrame:
    """(path, content) rows to copy out as ``<bundle>.warc.zst`` files with any
    tool that writes a file per row; the content is a complete archive."""
    return bundles.select(F.concat("bundle", F.lit(".warc.zst")).alias("path"), F.col("data").alias("content"))
