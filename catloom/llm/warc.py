"""WARC archives in seekable Zstandard bundles, with revisit records for repeated payloads.

Every task writes one bundle: records are grouped into independent Zstandard frames of about ``FRAME_BYTES``
(a longer record has a frame to itself), and a footer - a skippable frame with the sizes of all frames in the
seekable format - lets a reader jump to any frame. A record is addressed by bundle, frame and offset inside the
decompressed frame; the manifest maps record ids to these addresses.

Payload digests are computed JVM-side. Of equal payloads of at least ``min_bytes`` bytes the record with the
smallest id is the response, the others are revisits that point to it; the smallest id per digest is found by a
map-side combined aggregate; digests that make up more than a ``HOT``-th of all repeats are looked up by a broadcast, the others by a
shuffle, so no task gets all records of one payload. Payloads stay where they are unless the revisits are too many to broadcast.

Bundles go to the shared folder under a name of their own for every task attempt; only the attempt whose manifest
rows are committed counts, so lost executors and retries leave unused files, never wrong ones.

Defined results: a null payload is the empty payload; null ids and urls are written as empty fields (a null id
sorts after every other as a response); equal rows are records of their own; an empty table gives an empty
manifest; other columns are not read. Nothing is truncated: a very long payload has a frame to itself, compressed in one
piece, so a task holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom.runtime import cut, shared_path, spread, stored

FRAME_BYTES = 1 << 18
MIN_BYTES = 0
#: Revisits (about 40 bytes) that are broadcast at most.
BROADCAST_KEYS = 500_000
HOT = 1024
# Fixed values of the seekable Zstandard format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
READ = "record_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
READ_NAMES = [f.split()[0] for f in READ.split(", ")]
MANIFEST = "record_id long, bundle string, frame int, frame_start long, frame_size long, offset int, length int"


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer for frames of ``(compressed, decompressed)`` sizes."""
    body = b"".join(struct.pack("<II", c, d) for c, d in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(handle) -> list[tuple[int, int, int]]:
    """``(start, compressed, decompressed)`` of every frame of an open bundle."""
    handle.seek(0, 2)
    size = handle.tell()
    handle.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", handle.read(9))
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table")
    handle.seek(size - 9 - 8 * n)
    entries, frames, at = handle.read(8 * n), [], 0
    for c, d in struct.iter_unpack("<II", entries):
        frames.append((at, c, d))
        at += c
    return frames


def record(record_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit carries headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    clean = "".join(" " if c in "\r\n" else c for c in url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:record:{'' if record_id is None else record_id}>",
        f"WARC-Target-URI: {clean}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:record:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(frame: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, headers, payload)`` of every record of a decompressed frame."""
    at = 0
    while at < len(frame):
        head = frame.index(b"\r\n\r\n", at)
        version, *lines = frame[at:head].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"not a record: {version}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        block = frame[head + 4 : head + 4 + int(headers["Content-Length"])]
        yield at, headers, block.split(b"\r\n\r\n", 1)[1]
        at = head + 8 + int(headers["Content-Length"])


def parse_id(value: str | None) -> int | None:
    digits = (value or "").removeprefix("<urn:record:").removesuffix(">")
    return int(digits) if digits else None


class BundleWriter:
    """Streams records into frames; gives the manifest rows when closed."""

    def __init__(self, folder: str):
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = fs.open_output_stream(f"{base}/{self.name}", compression=None)
        self.frames: list[tuple[int, int]] = []
        self.buffer: list[bytes] = []
        self.size = self.written = 0
        self.waiting: list[tuple] = []
        self.rows: list[tuple] = []

    def add(self, record_id: int | None, raw: bytes) -> None:
        if self.size and self.size + len(raw) > FRAME_BYTES:
            self.end_frame()
        self.waiting.append((record_id, self.size, len(raw)))
        self.buffer.append(raw)
        self.size += len(raw)

    def end_frame(self) -> None:
        if not self.size:
            return
        packed = zstandard.ZstdCompressor(level=3).compress(b"".join(self.buffer))
        self.out.write(packed)
        self.rows += [(i, self.name, len(self.frames), self.written, len(packed), a, n) for i, a, n in self.waiting]
        self.frames.append((len(packed), self.size))
        self.written += len(packed)
        self.buffer, self.waiting, self.size = [], [], 0

    def close(self) -> list[tuple]:
        self.end_frame()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return self.rows


def with_references(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``record_id, url, payload, refers_to, digest``; a null reference is a response. Of repeated ids with equal payloads the
    rows are all responses if the id is the smallest."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).cast("long").alias("record_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    narrow = base.select("record_id", F.unhex(F.sha1("payload")).alias("digest"), F.octet_length("payload").alias("bytes"))
    large = narrow.filter(F.col("bytes") >= min_bytes)
    first = cut(large.groupBy("digest").agg(F.min("record_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # payloads of more than a HOT-th of all records that repeat, so at most HOT, are looked up in place
    floor = (first.agg(F.sum("n")).first()[0] or 0) // HOT
    hot = F.broadcast(first.filter(F.col("n") > max(floor, 2)).drop("n"))
    rest = large.join(hot.select("digest"), "digest", "left_anti").join(first.drop("n"), "digest")
    revisits = large.join(hot, "digest").unionByName(rest).filter("not record_id <=> first").select("record_id", F.col("first").alias("refers_to"), "digest")
    keyed = base.withColumn("digest", F.unhex(F.sha1("payload")))
    # few revisits are looked up in place; many make the payloads move once
    revisits = cut(revisits.distinct().withColumnsRenamed({"record_id": "i", "digest": "d"}))
    revisits = F.broadcast(revisits) if revisits.count() <= BROADCAST_KEYS else revisits.hint("shuffle_hash")
    found = keyed.join(revisits, F.col("record_id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")), "left")
    return found.select("record_id", "url", "payload", "refers_to", F.upper(F.hex("digest")).alias("digest"))


def write_bundles(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write all records as bundles into ``folder``; the stored manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for i, url, payload, refers, digest in zip(*(batch.column(k) for k in range(5))):
                writer = writer or BundleWriter(folder)
                digest = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                writer.add(i.as_py(), record(i.as_py(), url.as_py(), payload.as_py(), digest, refers.as_py()))
        if writer:
            frame = pd.DataFrame(writer.close(), columns=[f.split()[0] for f in MANIFEST.split(", ")])
            types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([None if pd.isna(x) else x for x in frame[c].tolist()], t) for c, t in zip(frame, types)], names=list(frame))

    return stored(with_references(pages, id_col, url_col, payload_col, min_bytes).mapInArrow(run, MANIFEST), "warc-manifest")


def read_bundles(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Every record read back: headers parsed, payloads decompressed and their digests verified.

    Work is dealt by frame, not by bundle. ``payload`` is null for revisits.
    """
    frames = manifest.groupBy("bundle", "frame").agg(F.count(F.lit(1)).alias("records"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        tables: dict[str, list[tuple[int, int, int]]] = {}
        for batch in batches:
            for name, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{base}/{name}") as handle:
                    if name not in tables:
                        tables[name] = read_seek_table(handle)
                    start, packed, size = tables[name][number]
                    handle.seek(start)
                    raw = zstandard.ZstdDecompressor().decompress(handle.read(packed), max_output_size=size)
                rows = []
                for at, headers, payload in parse_records(raw):
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and (base32_sha1(payload) != digest or len(payload) != int(headers["WARC-Payload-Length"])):
                        raise ValueError(f"damaged record in {name}, frame {number}, offset {at}")
                    rows.append((parse_id(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], int(headers["WARC-Payload-Length"]), digest, kind,
                                 parse_id(headers.get("WARC-Refers-To")), payload if kind == "response" else None))
                columns = list(zip(*rows))
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=READ_NAMES)

    return spread(frames.select("bundle", "frame"), "bundle", "frame").mapInArrow(run, READ)


def fetch(folder: str, row: dict) -> tuple[dict[str, str], bytes]:
    """One record by its manifest row: headers and payload, decompressing its frame only."""
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{base}/{row['bundle']}") as handle:
        handle.seek(row["frame_start"])
        packed = handle.read(row["frame_size"])
        size = read_seek_table(handle)[row["frame"]][2]
    raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=size)
    _, headers, payload = next(parse_records(raw[row["offset"] : row["offset"] + row["length"]]))
    return headers, payload


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_BYTES) -> tuple[str, DataFrame]:
    """Write ``pages`` to a fresh folder under the shared one: ``(folder, manifest)``."""
    folder = shared_path(pages.sparkSession, "warc")
    return folder, write_bundles(pages, folder, id_col, url_col, payload_col, min_bytes)
