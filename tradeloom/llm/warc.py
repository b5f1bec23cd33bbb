"""Web pages as WARC records in seekable Zstandard bundles.

A bundle is a run of frames that can be decompressed on their own, followed by a seek table in a skippable frame, so
that any Zstandard decoder reads it from end to end, and one that knows the table reads a single frame. Records are
grouped into frames of about ``FRAME_BYTES``, and an index maps each record's identifier to its bundle, frame, offset in
the frame's content and length. Of records with one payload of ``LEAST_REVISIT`` bytes or more, the one of least
``page_id`` is a response, and the others are revisit records that refer to it and hold no payload.

Bundles are files in the shared folder, written by Spark's text writer, one row a file: a row's bytes, then the
"line separator", which here is the seek table's last byte. So they are committed like any other output: a lost
executor's attempt leaves nothing behind. Files are read back through Spark as well.

A null ``html`` is an empty payload. A null ``page_id`` counts as larger than every other; a null ``url`` is left out.
Rows that repeat a ``page_id`` are written each; those with the payload of a response of their own id are responses too.
Other columns are not looked at; an empty table makes no bundles and gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import stage
from tradeloom.llm.wordblocks import arrow
from tradeloom.storage import shared_root

FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 32 << 20
LEAST_REVISIT = 100
NO_ID = (1 << 63) - 1
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the Zstandard format for skippable frames and seek tables.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
LAST_BYTE = "\x8f"

BUNDLES = (
    "bundle string, data binary, record_ids array<string>, frames array<int>, offsets array<bigint>, lengths array<bigint>"
)
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def record_id(page_id: int | None) -> str:
    return "<urn:page:null>" if page_id is None else f"<urn:page:{page_id}>"


def _page(identifier: str) -> int | None:
    number = identifier[len("<urn:page:") : -1]
    return None if number == "null" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC record. The full payload's digest and size stand in the header of a revisit too."""
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        clean = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        head.append(f"WARC-Target-URI: {clean}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Size: {size}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        head += [f"WARC-Refers-To: {record_id(refers_to)}"]
    body = payload if refers_to is None else b""
    head += ["Content-Type: text/html", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse(content: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and body of the record at ``at``, and where the next one begins."""
    end = content.index(b"\r\n\r\n", at)
    lines = content[at:end].decode().split("\r\n")
    head = dict(line.split(": ", 1) for line in lines[1:])
    begin = end + 4
    size = int(head["Content-Length"])
    return head, content[begin : begin + size], begin + size + 4


class Bundle:
    """Frames that were closed, and the records of the one that is open."""

    def __init__(self, name: str):
        self.name, self.frames, self.table = name, [], []
        self.open, self.open_bytes, self.bytes = [], 0, 0
        self.index: tuple[list, list, list, list] = ([], [], [], [])

    def add(self, identifier: str, content: bytes) -> None:
        if self.open and self.open_bytes + len(content) > FRAME_BYTES:
            self.close_frame()
        for column, value in zip(self.index, (identifier, len(self.frames), self.open_bytes, len(content)), strict=True):
            column.append(value)
        self.open.append(content)
        self.open_bytes += len(content)
        self.bytes += len(content)

    def close_frame(self) -> None:
        frame = zstandard.ZstdCompressor(level=3).compress(b"".join(self.open))
        self.frames.append(frame)
        self.table.append((len(frame), self.open_bytes))
        self.open, self.open_bytes = [], 0

    def close(self) -> bytes:
        """The bundle without its last byte."""
        if self.open:
            self.close_frame()
        entries = b"".join(struct.pack("<II", *e) for e in self.table)
        foot = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        table = struct.pack("<II", SKIPPABLE, len(entries) + len(foot)) + entries + foot
        return (b"".join(self.frames) + table)[:-1]


def seek_table(data: bytes) -> list[tuple[int, int]]:
    """Where each frame of a bundle begins, and how long it is."""
    n, _, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    places, at, begin = [], len(data) - 9 - 8 * n, 0
    for i in range(n):
        size, _ = struct.unpack_from("<II", data, at + 8 * i)
        places.append((begin, size))
        begin += size
    return places


def frame(data: bytes, number: int) -> bytes:
    begin, size = seek_table(data)[number]
    return zstandard.ZstdDecompressor().decompress(data[begin : begin + size])


def _bundles(pages: DataFrame) -> DataFrame:
    def run(batches) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        bundle = Bundle(f"{task:06d}-{number:06d}")

        def row(b: Bundle) -> pa.RecordBatch:
            ids, frames, offsets, lengths = b.index
            out = {"bundle": [b.name], "data": [b.close()], "record_ids": [ids], "frames": [frames]}
            return pa.RecordBatch.from_pydict(out | {"offsets": [offsets], "lengths": [lengths]}, schema=arrow(BUNDLES))

        for batch in batches:
            for r in batch.to_pylist():
                content = record(r["page_id"], r["url"], r["payload"], r["digest"], r["bytes"], r["refers_to"])
                if bundle.bytes and bundle.bytes + len(content) > BUNDLE_BYTES:
                    yield row(bundle)
                    number += 1
                    bundle = Bundle(f"{task:06d}-{number:06d}")
                bundle.add(record_id(r["page_id"]), content)
        if bundle.bytes:
            yield row(bundle)

    return pages.mapInArrow(run, BUNDLES)


def _decided(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest, size and, for revisits, the page that they refer to.

    Equal payloads meet as digests, pre-aggregated; the payloads themselves are shuffled once, by page.
    """
    page = F.col("page_id").cast("bigint")
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.coalesce(page, F.lit(NO_ID)).alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("bigint")})
    marks = stage(rows.filter(F.col("bytes") >= LEAST_REVISIT).select("page_id", "digest"), "digests")
    first = marks.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first < last")
    revisits = marks.join(first.drop("last"), "digest").filter("page_id > first").dropDuplicates(["page_id", "digest"])
    found = rows.join(revisits, ["page_id", "digest"], "left")
    return found.select(_known("page_id"), "url", "payload", "digest", "bytes", F.col("first").alias("refers_to"))


def _known(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)


def write(pages: DataFrame, path: str | None = None) -> tuple[str, DataFrame]:
    """Write the pages' bundles to files below ``path`` (in the shared folder, if not given), and give the folder
    and the index: record_id, bundle, frame, offset, length."""
    path = path or f"{shared_root(pages.sparkSession)}/llm/warc-{uuid.uuid4().hex}"
    found = stage(_bundles(_decided(pages)), "bundles")
    rows = found.select(F.col("data").cast("string").alias("value"))
    options = {"maxRecordsPerFile": "1", "lineSep": LAST_BYTE, "encoding": "ISO-8859-1"}
    rows.write.options(**options).text(path)
    places = F.arrays_zip("record_ids", "frames", "offsets", "lengths")
    index = found.select("bundle", F.explode(places).alias("x")).select(
        F.col("x.record_ids").alias("record_id"), "bundle", F.col("x.frames").alias("frame"),
        F.col("x.offsets").alias("offset"), F.col("x.lengths").alias("length"),
    )
    return path, index


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all bundles below ``path``, frame by frame: page_id, size and digest of the full payload, type,
    and the page that a revisit refers to. A response whose payload doesn't match its digest stops the job."""

    def run(batches):
        for batch in batches:
            for data in batch.column("content").to_pylist():
                for number in range(len(seek_table(data))):
                    content, at = frame(data, number), 0
                    out: dict[str, list] = {c.split()[0]: [] for c in RECORDS.split(", ")}
                    while at < len(content):
                        head, body, at = parse(content, at)
                        digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["WARC-Payload-Size"])
                        if head["WARC-Type"] == "response" and (len(body), hashlib.sha256(body).hexdigest()) != (size, digest):
                            raise ValueError(f"{head['WARC-Record-ID']}: payload doesn't match its digest")
                        other = head.get("WARC-Refers-To")
                        row = (_page(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], _page(other) if other else None)
                        for k, v in zip(out, row, strict=True):
                            out[k].append(v)
                    yield pa.RecordBatch.from_pydict(out, schema=arrow(RECORDS))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the bundles, then read every record back."""
    path, _ = write(pages)
    return read(pages.sparkSession, path)
