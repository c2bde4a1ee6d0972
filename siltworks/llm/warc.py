"""WARC archives as seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding a group of whole WARC records, and then a seek table
in a skippable frame (the published seekable format: magic 0x184D2A5E, one entry of compressed and decompressed size
a frame, footer with the number of frames, a flag byte and the magic 0x8F92EAB1).  The index maps a record identifier
to bundle, frame, offset in the decompressed frame and length, so one record is read with one frame.

Pages of equal payload (same SHA-256) are stored once: the largest page_id as a response, the others as revisits.

A bundle's name is new in every attempt of a task.  The index is a written table, so it names the bundles of the
attempts that were committed, and readers open those alone: what a lost or repeated attempt left behind is not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, new_path, partitions, released, with_leaders
from .textops import buffers

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed by the seekable format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
INDEX = "page_id long, record_id string, record_type string, bundle string, frame int, offset long, length long"
RECORDS = "page_id long, url string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to_record string, refers_to long, payload binary"


def record_id(page: int | None, digest: str) -> str:
    """Of a capture of a page: rows that repeat page and payload are one capture, so they share it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers: int | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block, digest = http if refers is not None else http + payload, sha1_base32(payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {record_id(page, digest)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}", "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers, digest)}", f"X-Refers-To-Page-Id: {refers}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """Collects records into frames; finish() gives the bundle's bytes."""

    def __init__(self, frame_bytes: int, level: int):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True).compress
        self.frame_bytes, self.frames, self.sizes, self.open, self.held, self.size = frame_bytes, [], [], [], 0, 0

    def add(self, raw: bytes) -> tuple[int, int]:
        at = (len(self.frames), self.held)
        self.open.append(raw)
        self.held += len(raw)
        if self.held >= self.frame_bytes:
            self.close()
        return at

    def close(self) -> None:
        if self.open:
            frame = self.pack(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.held))
            self.size += len(frame)
            self.open, self.held = [], 0

    def finish(self) -> bytes:
        self.close()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join([*self.frames, struct.pack("<II", SKIPPABLE, len(table)), table])


def seek_table(data: bytes | memoryview) -> list[tuple[int, int, int]]:
    """(place, compressed size, decompressed size) of each frame, from the bundle's footer."""
    n, flag, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    wide = 12 if flag & 0x80 else 8
    entries, place, out = data[len(data) - 9 - n * wide : len(data) - 9], 0, []
    for i in range(n):
        small, large = struct.unpack_from("<II", entries, i * wide)
        out.append((place, small, large))
        place += small
    return out


def read_frame(data: bytes | memoryview, frame: int) -> bytes:
    import zstandard

    place, small, large = seek_table(data)[frame]
    return zstandard.ZstdDecompressor().decompress(bytes(data[place : place + small]), max_output_size=large)


def put(directory: str, name: str, data: bytes) -> None:
    """Write a file of the shared folder so that it is there whole or not at all."""
    url = urlparse(directory)
    if url.scheme in ("", "file"):
        folder = unquote(url.path)
        os.makedirs(folder, exist_ok=True)
        part = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, f"{folder}/{name}")
    else:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(directory)
        with store.open_output_stream(f"{folder}/{name}") as f:
            f.write(data)


def get(directory: str, name: str) -> bytes:
    url = urlparse(directory)
    if url.scheme in ("", "file"):
        with open(f"{unquote(url.path)}/{name}", "rb") as f:
            return f.read()
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(directory)
    with store.open_input_stream(f"{folder}/{name}") as f:
        return f.read()


def write_bundles(pages: DataFrame, directory: str, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 25, level: int = 3) -> DataFrame:
    """Write pages (page_id, url, html, refers_to) as bundles and return the index, lazily: it must be materialised.

    Bundles are read back through the index, whatever else the folder holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt, k, rows = task.partitionId() if task else 0, uuid.uuid4().hex, 0, []
        bundle = Bundle(frame_bytes, level)
        names = [x.split()[0] for x in INDEX.split(", ")]
        schema = pa.schema(list(zip(names, [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()], strict=True)))

        def finish() -> pa.RecordBatch:
            put(directory, name(), bundle.finish())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

        def name() -> str:
            return f"pages-{part:06d}-{k:05d}-{attempt}.warc.zst"

        for batch in batches:
            data, at = buffers(batch.column("html"))
            raw = memoryview(data)
            for i, (page, url, refers) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to")), strict=True)):
                one = record(page, url, bytes(raw[at[i] : at[i + 1]]), refers)
                frame, offset = bundle.add(one)
                rows.append((page, record_id(page, sha1_base32(bytes(raw[at[i] : at[i + 1]]))), "response" if refers is None else "revisit", name(), frame, offset, len(one)))
                if bundle.size >= bundle_bytes:
                    yield finish()
                    bundle, rows, k = Bundle(frame_bytes, level), [], k + 1
        if rows:
            yield finish()

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(released(run), INDEX)


def parse(raw: bytes) -> Iterator[dict]:
    """The records of a decompressed frame."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not start with its version")
        head = dict(x.split(": ", 1) for x in lines[1:])
        n = int(head["Content-Length"])
        block = raw[end + 4 : end + 4 + n]
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = head["WARC-Type"]
        if head["WARC-Block-Digest"].removeprefix("sha1:") != sha1_base32(block) or kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
            raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
        yield {
            "page_id": int(head["X-Page-Id"]) if "X-Page-Id" in head else None, "url": head.get("WARC-Target-URI"), "record_id": head["WARC-Record-ID"], "record_type": kind,
            "payload_bytes": size, "payload_digest": digest, "refers_to_record": head.get("WARC-Refers-To"),
            "refers_to": int(head["X-Refers-To-Page-Id"]) if "X-Refers-To-Page-Id" in head else None, "payload": payload if kind == "response" else None,
        }
        at = end + 4 + n + 4


_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
_SCHEMA = pa.schema(list(zip([x.split()[0] for x in RECORDS.split(", ")], _KINDS, strict=True)))


def read_bundles(spark: SparkSession, directory: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles that index names, read frame by frame; digests are checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                data = memoryview(get(directory, name))
                for k in range(len(seek_table(data))):
                    rows = list(parse(read_frame(data, k)))
                    if not payloads:
                        for x in rows:
                            x["payload"] = None
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return _dealt(index.select("bundle").distinct()).mapInArrow(released(run), RECORDS)


def _dealt(bundles: DataFrame) -> DataFrame:
    """A row a bundle, a few bundles a task: rows are small, so the planner would put all into one."""
    return bundles.repartition(max(partitions(bundles.sparkSession), 1), "bundle")


def read_records(spark: SparkSession, directory: str, index: DataFrame) -> DataFrame:
    """The records that the rows of index name (see write_bundles), each from its frame and offset alone."""
    wanted = index.groupBy("bundle").agg(F.collect_list(F.struct("frame", "offset", "length")).alias("places"))  # bounded by the bundle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, places in zip(batch.column("bundle").to_pylist(), batch.column("places").to_pylist(), strict=True):
                data, frames = memoryview(get(directory, name)), {}
                for x in sorted(places, key=lambda x: (x["frame"], x["offset"])):
                    raw = frames.setdefault(x["frame"], None) or read_frame(data, x["frame"])
                    frames = {x["frame"]: raw}
                    yield pa.RecordBatch.from_pylist(list(parse(raw[x["offset"] : x["offset"] + x["length"]])), schema=_SCHEMA)

    return _dealt(wanted).mapInArrow(released(run), RECORDS)


def with_revisits(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with refers_to: null for responses, else the page_id of the response.

    The payload is the html in UTF-8, null as empty.  A null page_id is smaller than any other; rows that repeat the
    largest page_id of a payload are all responses.
    """
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("payload_key", F.unhex(F.sha2("html", 256)))
    low = F.coalesce("page_id", F.lit(-(2**63)))
    keyed = with_leaders(own, ["payload_key"], low, F.max)
    return keyed.select("page_id", "url", "html", F.when(low < F.col("leader"), F.col("leader")).alias("refers_to"))


def archive(pages: DataFrame, directory: str | None = None) -> tuple[str, DataFrame]:
    """Write pages as bundles into directory (a new shared folder by default); the folder and the written index."""
    directory = directory or new_path(pages.sparkSession, "warc")
    return directory, materialise(write_bundles(with_revisits(pages), directory), "warc-index")


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive pages (page_id, url, html) and read the archives back: one row per row, without payloads.

    Null html is an empty payload; a null page_id is written without one and smaller than any other; rows that repeat
    page_id and payload come back as often.  Payloads are read whole, however long: a record is in one frame.  An empty
    table writes no bundle and gives an empty result.  Other columns are not read.
    """
    spark = pages.sparkSession
    directory, index = archive(pages)
    return read_bundles(spark, directory, index, payloads=False).drop("payload")
