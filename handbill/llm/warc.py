"""WARC records in seekable Zstandard bundles.

Each task groups its records into frames that decompress on their own, of at least ``FRAME`` bytes of records,
and frames into bundles of about ``BUNDLE`` compressed bytes. A bundle ends with two skippable frames: the record
table (record id, frame, offset in the frame) and the public seek table, whose footer gives the number of frames.
``record`` reads one record with the footer, the tables and a single frame.

Records of one payload (by SHA-1 and length) are written once: the one of the largest page_id is a response, the
others are revisits that refer to it and hold only headers.

A bundle has its content's hash in its name, is written beside it and then moved, so a task that runs twice, or
on another executor, leaves the same file. Only bundles that the index names count; the index is a table
that Spark commits. Folders are reached through the Arrow file systems (file, hdfs, s3).

Defined cases: a null html is the empty payload, a null url ``urn:null``; a null page_id counts as the
smallest; rows that repeat a page_id and payload share their fate; equal payloads without any page_id are
responses. An html of any length is one record, held whole by the task that writes it. An empty table writes no bundle, its index is empty. Only page_id, url and
html are read, so columns of other names do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, new_path, stored

#: Bytes of records to a frame and of frames to a bundle, at least; what one record exceeds them by comes on top.
FRAME, BUNDLE = 1 << 17, 8 << 20
#: Fixed values of the public seekable format and of skippable frames.
SEEK_MAGIC, SEEK_FOOTER, TABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
DATE = "2024-01-15T00:00:00Z"
#: Characters that stay in a header's address as they are; all others are written as their UTF-8 bytes in percent form.
_IN_URI = "%/:?#[]@!$&'()*+,;=~"

INDEX = "page_id long, record_id string, record_type string, bundle string, frame int, offset long, length long"
_INDEX = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])


def open_dir(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://")) if "://" in uri else (fs.LocalFileSystem(), uri.removeprefix("file:"))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(kind: str, page_id: int | None, sha: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{sha}|{kind}')}>"


def encode(page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: int | None, revisit: bool) -> tuple[str, bytes]:
    kind = "revisit" if revisit else "response"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    rid = record_id(kind, page_id, sha)
    uri = "urn:null" if url is None else quote(url, safe=_IN_URI) or "urn:empty"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{sha}", f"WARC-Identified-Page: {'' if page_id is None else page_id}", "Content-Type: application/http;msgtype=response"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id('response', refers_to, sha)}", f"WARC-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return rid, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """The headers and payload of the record at the start, and its length. A response whose payload does not have
    the digest that its header names is an error."""
    end = data.index(b"\r\n\r\n")
    version, *lines = data[:end].decode().split("\r\n")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    if version != "WARC/1.1":
        raise ValueError(f"not a record: {version[:20]}")
    start, n = end + 4, int(head["Content-Length"])
    block = data[start : start + n]
    http, _, payload = block.partition(b"\r\n\r\n")
    head["Payload-Length"] = next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:]
    if head["WARC-Type"] == "response" and (f"sha1:{digest(payload)}" != head["WARC-Payload-Digest"] or len(payload) != int(head["Payload-Length"])):
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not have its digest")
    return head, payload, start + n + 4


class Bundle:
    """Collects records into frames; ``close`` gives the bytes."""

    def __init__(self):
        self.frames, self.sizes, self.open, self.held, self.places, self.total = [], [], [], 0, [], 0
        self.zstd = zstandard.ZstdCompressor(level=3)

    def add(self, rid: str, data: bytes) -> tuple[int, int]:
        place = (len(self.frames), self.held)
        self.places.append((rid, *place))
        self.open.append(data)
        self.held += len(data)
        if self.held >= FRAME:
            self.end_frame()
        return place

    def end_frame(self) -> None:
        if self.open:
            frame = self.zstd.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.held))
            self.total += len(frame)
            self.open, self.held = [], 0

    def close(self) -> bytes:
        self.end_frame()
        table = zstandard.ZstdCompressor(level=3).compress(json.dumps(self.places).encode())
        seek = b"".join(struct.pack("<II", *x) for x in [*self.sizes, (len(table) + 8, 0)]) + struct.pack("<IBI", len(self.sizes) + 1, 0, SEEK_FOOTER)
        return b"".join(self.frames) + struct.pack("<II", TABLE_MAGIC, len(table)) + table + struct.pack("<II", SEEK_MAGIC, len(seek)) + seek


def seek_table(tail: bytes) -> list[tuple[int, int]]:
    """Compressed and plain sizes of all frames, the last the record table, from the end of a bundle."""
    n, _, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEK_FOOTER:
        raise ValueError("no seek table")
    at = len(tail) - 9 - 8 * n
    return [struct.unpack("<II", tail[at + 8 * k : at + 8 * k + 8]) for k in range(n)]


def record(uri: str, rid: str) -> tuple[dict[str, str], bytes]:
    """One record of a bundle: reads the footer, the tables and the one frame that holds it."""
    files, path = open_dir(uri)
    with files.open_input_file(path) as f:
        size = f.size()
        n = struct.unpack("<IBI", f.read_at(9, size - 9))[0]
        whole = 17 + 8 * n
        sizes = seek_table(f.read_at(whole, size - whole))
        table_at = size - whole - sizes[-1][0]
        places = json.loads(zstandard.ZstdDecompressor().decompress(f.read_at(sizes[-1][0] - 8, table_at + 8)))
        frame, offset = next((fr, off) for r, fr, off in places if r == rid)
        start = sum(c for c, _ in sizes[:frame])
        data = zstandard.ZstdDecompressor().decompress(f.read_at(sizes[frame][0], start))
    return decode(data[offset:])[:2]


def _writer(uri: str):
    def put(bundle: Bundle, rows: list[dict]) -> pa.RecordBatch:
        data = bundle.close()
        files, path = open_dir(uri)
        name = f"{hashlib.sha256(data).hexdigest()[:40]}.warc.zst"
        beside = f"{path}/_{uuid.uuid4().hex}"
        with files.open_output_stream(beside) as f:
            f.write(data)
        files.move(beside, f"{path}/{name}")
        return pa.RecordBatch.from_pylist([r | {"bundle": name} for r in rows], schema=_INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, rows = Bundle(), []
        for batch in batches:
            for k in range(batch.num_rows):
                page_id, url, html, refers, revisit = (batch.column(i)[k].as_py() for i in range(5))
                payload = (html or "").encode("utf-8", "surrogatepass")
                rid, data = encode(page_id, url, payload, digest(payload), refers, revisit)
                frame, offset = bundle.add(rid, data)
                rows.append({"page_id": page_id, "record_id": rid, "record_type": "revisit" if revisit else "response", "frame": frame, "offset": offset, "length": len(data)})
                if bundle.total >= BUNDLE:
                    yield put(bundle, rows)
                    bundle, rows = Bundle(), []
        if rows:
            yield put(bundle, rows)

    return run


def write(pages: DataFrame, path: str | None = None, least: int = 0) -> tuple[str, DataFrame]:
    """Write one record per page; gives the folder of the bundles and the index. Records of equal payloads of at least
    ``least`` bytes become one response and revisits of it."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    files, at = open_dir(path)
    files.create_dir(at, recursive=True)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    rows = pages.withColumns({"sha": F.sha1(F.coalesce("html", F.lit("")).cast("binary")), "n": F.coalesce(F.octet_length("html"), F.lit(0))})
    marks = stored(rows.groupBy("page_id", "sha", "n").agg(F.count("*").alias("times")), "warc-marks")
    largest = marks.where(F.col("n") >= least).groupBy("sha").agg(F.max("page_id").alias("refers"))
    fates = marks.join(largest, "sha", "left").select(F.col("page_id").alias("of"), F.col("sha").alias("of_sha"), "refers", (F.col("refers").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers"))).alias("revisit"))
    fated = rows.join(fates, F.col("page_id").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("of_sha")))
    index = stored(fated.select("page_id", "url", "html", "refers", "revisit").mapInArrow(_writer(path), INDEX), "warc-index")
    discard(marks)
    return path, index


READ = "page_id long, record_id string, payload_bytes long, payload_digest string, record_type string, refers_to long, bundle string, frame int, offset long"
_READ = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64())])


def _parse(uri: str):
    """Reads bundles frame by frame, so that memory is a frame."""
    number = lambda x: int(x) if x else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        files, path = open_dir(uri)
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                with files.open_input_file(f"{path}/{name}") as f:
                    size = f.size()
                    whole = 17 + 8 * struct.unpack("<IBI", f.read_at(9, size - 9))[0]
                    at, rows = 0, []
                    for frame, (packed, plain) in enumerate(seek_table(f.read_at(whole, size - whole))[:-1]):
                        records, offset = unzip.decompress(f.read_at(packed, at), max_output_size=plain), 0
                        at += packed
                        while offset < plain:
                            head, _, length = decode(records[offset:] if offset else records)
                            rows.append((number(head["WARC-Identified-Page"]), head["WARC-Record-ID"], int(head["Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"], number(head.get("WARC-Refers-To-Page")), name, frame, offset))
                            offset += length
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ.types, strict=True)], schema=_READ)

    return run


def read(path: str, index: DataFrame) -> DataFrame:
    """All records of the bundles that the index names, every payload checked against its digest."""
    names = stored(index.select("bundle").distinct(), "warc-bundles")
    # a number of tasks by that of the bundles: the planner sees only their names, and would read all in one
    n = names.count()
    return names.repartition(max(1, n if n < 4096 else 4096 + n // 16), "bundle").mapInArrow(_parse(path), READ)
