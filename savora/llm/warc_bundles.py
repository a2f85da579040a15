"""WARC: seekable Zstandard bundles of archived pages.

Each page is one WARC record.  Records are collected into frames of about ``frame_bytes``, each compressed on its own;
a bundle is a file of frames, closed by a seek table in a skippable frame (the Zstandard seekable format), so
any reader of Zstandard can unpack it whole and a reader of the seek table can unpack one frame.  The index says for each record its bundle, its
frame and the offset and length inside the unpacked frame.

Pages with equal payloads of at least ``least_bytes`` are archived once: the one with the smallest id is a
response, the others are revisits that name it.  Tasks write bundles under the shared folder, each attempt to names of its own; the
index holds the names of the attempts that succeeded, so a task that runs twice harms nothing.

Defined cases: a null payload is an empty one; a null url is empty; a null page id counts as larger than any other; further rows with
the id of the response are responses, too, and equal payloads of which none has an id all are; ``row`` tells such rows apart; a record
larger than a frame is a frame of its own; no pages give no bundles and no rows.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid
from typing import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from savora.llm.common import new_path, stored

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 64 << 20
LEAST_BYTES = 100
# fixed values of the seekable format
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN_AT = "1970-01-01T00:00:00Z"

INDEX = "row bigint, page_id bigint, bundle string, frame int, offset bigint, length bigint"
RECORDS = "row bigint, page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary"


def arrow_schema(spec: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in spec.split(", "))])


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{row}')}>"


def to_record(row: int, page_id: int | None, url: str, payload: bytes, digest: str, revisit_of: int | None) -> bytes:
    """One WARC record.  A revisit holds no payload, but says its digest and size."""
    block = b"" if revisit_of is not None else payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if revisit_of is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, row)}",
            f"WARC-Date: {WRITTEN_AT}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{digest}",
            f"Page-Row: {row}", f"Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if revisit_of is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"Refers-To-Page: {revisit_of}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def from_record(raw: bytes) -> dict:
    """The fields of one record, checked against its own digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (hashlib.sha256(block).hexdigest(), len(block)) != (digest, int(fields["Payload-Length"])):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = {k: int(fields[k]) if k in fields else None for k in ("Page-Row", "Page-Id", "Refers-To-Page", "Payload-Length")}
    return {"row": number["Page-Row"], "page_id": number["Page-Id"], "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
            "payload_digest": digest, "payload_bytes": number["Payload-Length"], "refers_to": number["Refers-To-Page"],
            "payload": block if fields["WARC-Type"] == "response" else None}


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame with the (packed, unpacked) size of each frame; its footer stands at the end of the file."""
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int]]:
    """(start, packed size) of each frame, from the end of the file."""
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * n)
    sizes = [packed for packed, _ in struct.iter_unpack("<II", file.read(8 * n))]
    starts = [0]
    for packed in sizes:
        starts.append(starts[-1] + packed)
    return list(zip(starts, sizes))


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """Any store that Arrow reaches: a local or mounted path, file://, s3://, gs://, hdfs:// ..."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


class BundleWriter:
    """Writes one bundle and gives the index rows of its records."""

    def __init__(self, folder: str, name: str, frame_bytes: int):
        self.store, base = open_folder(folder)
        self.store.create_dir(base, recursive=True)
        self.name, self.frame_bytes = name, frame_bytes
        self.final = posixpath.join(base, name)
        self.part = f"{self.final}.{uuid.uuid4().hex}.part"
        self.file = self.store.open_output_stream(self.part)
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.pending: list[bytes] = []
        self.size = self.written = 0
        self.index: list[tuple] = []

    def add(self, row: int, page_id: int | None, record: bytes) -> None:
        if self.pending and self.size + len(record) > self.frame_bytes:
            self.close_frame()
        self.index.append((row, page_id, self.name, len(self.frames), self.size, len(record)))
        self.pending.append(record)
        self.size += len(record)

    def close_frame(self) -> None:
        packed = self.packer.compress(b"".join(self.pending))
        self.file.write(packed)
        self.frames.append((len(packed), self.size))
        self.written += len(packed)
        self.pending, self.size = [], 0

    def close(self) -> list[tuple]:
        if self.pending:
            self.close_frame()
        self.file.write(seek_table(self.frames))
        self.file.close()
        self.store.move(self.part, self.final)
        return self.index


def plan_records(pages: DataFrame, payload: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``(row, page_id, url, payload, digest, refers_to)`` of every page; the payload is shuffled once."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = (rows.filter(F.octet_length("payload") >= least_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    return rows.join(first, "digest", "left").select(
        "row", "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"))


def write_bundles(pages: DataFrame, folder: str, payload: str = "html", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
                  least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Archive every page under ``folder`` and return the stored index of the records."""
    schema = arrow_schema(INDEX)

    def rows_of(index: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, i)) for i in index], schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, filled = None, 0
        for part in parts:
            for at in range(0, part.num_rows, 256):
                for r in part.slice(at, 256).to_pylist():
                    if writer is None:
                        writer, filled = BundleWriter(folder, f"bundle-{uuid.uuid4().hex}.warc.zst", frame_bytes), 0
                    record = to_record(r["row"], r["page_id"], r["url"].replace("\r", "%0D").replace("\n", "%0A"), r["payload"], r["digest"], r["refers_to"])
                    writer.add(r["row"], r["page_id"], record)
                    filled += len(record)
                    if filled >= bundle_bytes:
                        yield rows_of(writer.close())
                        writer = None
        if writer is not None:
            yield rows_of(writer.close())

    return stored(plan_records(pages, payload, least_bytes).mapInArrow(batches, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of an index, each read through the seek table of its bundle."""
    schema = arrow_schema(RECORDS)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        unpack = zstandard.ZstdDecompressor()
        name, file, frames, at, frame = None, None, [], -1, b""
        for part in parts:
            out, size = [], 0
            for r in part.to_pylist():
                if r["bundle"] != name:
                    name, at = r["bundle"], -1
                    path = posixpath.join(base, name)
                    file = store.open_input_file(path)
                    frames = read_seek_table(file, file.size())
                if r["frame"] != at:
                    at = r["frame"]
                    file.seek(frames[at][0])
                    frame = unpack.decompress(file.read(frames[at][1]))
                record = from_record(frame[r["offset"]:r["offset"] + r["length"]])
                out.append(record)
                size += r["length"]
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    # hashing bundle and frame keeps each frame with one task and spreads a bundle over many
    return (index.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset").mapInArrow(batches, RECORDS))


def archive(pages: DataFrame, folder: str | None = None, **options) -> tuple[DataFrame, str]:
    """Write all pages; returns the index and the folder, a new one in the shared folder unless given."""
    folder = folder or new_path(pages.sparkSession, "warc")
    return write_bundles(pages, folder, **options), folder
