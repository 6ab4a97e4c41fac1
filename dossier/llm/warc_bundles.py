"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about ``FRAME_BYTES``. Behind
them a skippable frame holds the record index (record id, frame, offset inside the
decompressed frame, length), and a second one the seek table in the public seekable
format: compressed and decompressed size of every frame, their number, and the magic
number at the very end. A reader finds any record by reading the footer and one frame.
Common Zstandard tools decompress a bundle to a plain WARC file.

Of records with equal payloads the one with the largest id is the response; the others
are revisit records without payload that refer to it. Payloads shorter than
``least_bytes`` are always responses. Null payloads count as empty. Of rows without id,
all are revisits if any row with the same payload has one, else responses. Rows that
repeat an id and its payload are all written.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import work_dir, write_file, written

FRAME_BYTES = 1 << 18
#: A bundle is closed after this many decompressed bytes.
BUNDLE_BYTES = 1 << 26
SKIPPABLE = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
SEEK_MAGIC = 0x8F92EAB1
_NAMESPACE = uuid.UUID("6f1d5f3a-52f0-4b60-9a43-0d7c4cf4c1a1")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{key}:{digest}')}>"


def _field(value: str) -> str:
    """One line without control characters, as header values need it."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def make_record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with the payload, or a revisit that names its response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(key, digest)}",
        f"WARC-Target-URI: {_field(url or '')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if key is not None:
        head.append(f"X-Page-ID: {key}")
    if refers_to is None:
        body = http + payload
    else:
        body = http
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    return {"fields": fields, "payload": block.partition(b"\r\n\r\n")[2]}


class BundleWriter:
    """Collects records of one bundle."""

    def __init__(self, level: int = 6):
        self.level, self.frames, self.sizes, self.index = level, [], [], []
        self.open: list[bytes] = []
        self.open_bytes = self.total = 0

    def add(self, name: str, record: bytes) -> None:
        self.index.append((name, len(self.sizes), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)
        self.total += len(record)
        if self.open_bytes >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            data = zstandard.ZstdCompressor(level=self.level).compress(b"".join(self.open))
            self.frames.append(data)
            self.sizes.append((len(data), self.open_bytes))
            self.open, self.open_bytes = [], 0

    def bytes(self) -> bytes:
        self._close_frame()
        entries = b"".join(struct.pack("<H", len(n := name.encode())) + n + struct.pack("<IQQ", *place)
                           for name, *place in self.index)
        index = zstandard.ZstdCompressor(level=self.level).compress(struct.pack("<Q", len(self.index)) + entries)
        index_frame = struct.pack("<II", INDEX_FRAME, len(index)) + index
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<II", len(index_frame), 0)
        footer = struct.pack("<IBI", len(self.sizes) + 1, 0, SEEK_MAGIC)
        return b"".join(self.frames) + index_frame + struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer


class BundleReader:
    """Random access by the footer; only the frames asked for are decompressed."""

    def __init__(self, raw: bytes):
        count, _, magic = struct.unpack_from("<IBI", raw, len(raw) - 9)
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        self.raw = memoryview(raw)
        first = len(raw) - 9 - 8 * count
        self.starts, at = [], 0
        for packed, plain in struct.iter_unpack("<II", raw[first:len(raw) - 9]):
            self.starts.append((at, packed, plain))
            at += packed
        start, packed, _ = self.starts.pop()
        entries = zstandard.ZstdDecompressor().decompress(raw[start + 8:start + packed])
        (n,), at = struct.unpack_from("<Q", entries), 8
        self.index: list[tuple[str, int, int, int]] = []
        for _ in range(n):
            (length,) = struct.unpack_from("<H", entries, at)
            name = entries[at + 2:at + 2 + length].decode()
            self.index.append((name, *struct.unpack_from("<IQQ", entries, at + 2 + length)))
            at += 2 + length + 20
        self.held: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        if self.held[0] != number:
            start, packed, _ = self.starts[number]
            self.held = (number, zstandard.ZstdDecompressor().decompress(self.raw[start:start + packed]))
        return self.held[1]

    def at(self, place: int) -> dict:
        """The record at a place of the index."""
        _, number, offset, length = self.index[place]
        return parse_record(self.frame(number)[offset:offset + length])

    def find(self, name: str) -> dict | None:
        """The first record with an id."""
        return next((self.at(i) for i, entry in enumerate(self.index) if entry[0] == name), None)


def with_digests(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """Byte length and raw SHA-1 of each payload, by built-in functions."""
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    return pages.withColumn("_sha1", F.sha1(data)).withColumn("_bytes", F.octet_length(data).cast("long"))


def write_bundles(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url",
                  payload: str = "html", least_bytes: int = 0) -> str:
    """Write all rows as records; returns the folder.

    The largest id of each digest is an aggregate of digests (combined map-side). It is
    written before it is joined, so a payload that a third of the rows share is split by
    the adaptive skew join.
    """
    folder = folder or work_dir(pages.sparkSession, "warc")
    rows = with_digests(pages.select(F.col(key).cast("long").alias("k"), F.col(url).alias("u"), F.col(payload).alias("p")), "k", "p")
    last = written(
        with_digests(pages.select(F.col(key).cast("long").alias("k"), F.col(payload).alias("p")), "k", "p")
        .filter(F.col("_bytes") >= least_bytes).groupBy(F.col("_sha1").alias("_shared")).agg(F.max("k").alias("_last")), "digests")
    decided = rows.join(last, F.col("_sha1") == F.col("_shared"), "left").select(
        "k", "u", "p",
        F.when((F.col("_bytes") >= least_bytes) & ~F.col("k").eqNullSafe(F.col("_last")), F.col("_last")).alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, files, writer = TaskContext.get().partitionId(), 0, BundleWriter()

        def close() -> pa.RecordBatch:
            nonlocal files, writer
            path = f"{folder}/bundle-{task:06d}-{files:06d}.warc.zst"
            write_file(path, writer.bytes())
            row = pa.RecordBatch.from_pydict({"path": [path], "records": [len(writer.index)]})
            files, writer = files + 1, BundleWriter()
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for k, u, p, r in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    data = (p or "").encode()
                    digest = payload_digest(data)
                    writer.add(record_id(k, digest), make_record(k, u, data, digest, r))
                    if writer.total >= BUNDLE_BYTES:
                        yield close()
        if writer.index:
            yield close()

    # In a fixed order a repeated task writes the same bundles again.
    done = decided.sortWithinPartitions("k", "u", "p").mapInArrow(run, "path string, records long")
    done.write.parquet(f"{folder}-manifest")
    return folder


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_bundles(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of a folder of bundles. Revisits have no payload."""
    spark = manifest.sparkSession
    if not manifest.head(1):
        return spark.createDataFrame([], RECORD)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORD.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                bundle = BundleReader(content.as_py())
                for at in range(0, len(bundle.index), 256):
                    rows = []
                    for i in range(at, min(at + 256, len(bundle.index))):
                        record = bundle.at(i)
                        f = record["fields"]
                        kind = f["WARC-Type"]
                        rows.append((
                            int(f["X-Page-ID"]) if "X-Page-ID" in f else None, f["WARC-Target-URI"],
                            int(f["X-Payload-Length"]) if kind == "revisit" else len(record["payload"]),
                            f["WARC-Payload-Digest"].removeprefix("sha1:") if kind == "revisit" else payload_digest(record["payload"]),
                            kind, int(f["X-Refers-To-Page-ID"]) if "X-Refers-To-Page-ID" in f else None,
                            record["payload"] if with_payload and kind == "response" else None))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return files.mapInArrow(run, RECORD)
