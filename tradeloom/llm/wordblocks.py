"""Per-word values for every word of every text, without moving the words.

A block is a run of whole documents of one task, at most ``BLOCK_BYTES`` of text (one document at least). It
numbers its distinct words by frequency, so a text becomes a short list of small numbers, and asks for each
distinct word once. Requests travel by word: all requests for a word meet in one partition, where its value is
found once for the whole corpus. Answers travel by block and meet the numbered texts there. What is shuffled is
the distinct words of each block and the numbers, not the text; a frequent word costs one request per block,
so there is no hot word.

Requests and numbered texts come from two scans of the same input, so the input must yield the same rows in
the same order when it is read again, as files do (stage anything else first). Each block carries a
fingerprint of its ids and whole texts, and a difference stops the job.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

BLOCK_BYTES = 24 << 20
TEXTS_AT_ONCE = 256
#: Parts per shuffle partition: several small ones spread more evenly than one large one.
PARTS_PER_PARTITION = 4

REQUESTS = "part int, block bigint, fingerprint bigint, words binary, counts binary"
NUMBERED = "block bigint, fingerprint bigint, doc_ids array<bigint>, sizes array<int>, codes binary, parts binary"


class Numbers(dict):
    """Numbers keys in order of first sight."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def pack(values: np.ndarray, width: int = 4) -> bytes:
    """Unsigned numbers of ``width`` bytes, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype(f"<u{width}")).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, width: int = 4) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


def pack_words(words: list[bytes]) -> bytes:
    """Words hold no line break, so one separates them."""
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


def texts_of(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The batch's texts in UTF-8, a null as an empty one. They come a few at a time, so that a batch isn't held twice."""
    column = batch.column("text")
    for at in range(0, len(column), TEXTS_AT_ONCE):
        for text in column.slice(at, TEXTS_AT_ONCE).cast(pa.binary()).to_pylist():
            yield text or b""


class _Block:
    def __init__(self, number: int):
        self.number, self.numbers, self.codes = number, Numbers(), []
        self.doc_ids, self.sizes, self.size = [], [], 0
        self.weight: list[bool] = []
        self.print = xxhash.xxh64()

    def add(self, doc_id: int | None, text: bytes, lower: bool, counted: bool) -> None:
        words = (text.lower() if lower else text).split()  # bytes.lower() changes A-Z only
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.doc_ids.append(doc_id)
        self.sizes.append(len(words))
        self.weight.append(counted)
        self.size += len(text)
        self.print.update(b"%s %d " % (str(doc_id).encode(), len(text)))
        self.print.update(text)

    def close(self, parts: int) -> tuple[list[bytes], np.ndarray, np.ndarray, int]:
        """Words by falling frequency, the codes, the part of each word, and the fingerprint."""
        codes = np.concatenate(self.codes)
        freq = np.bincount(codes, minlength=len(self.numbers))
        order = np.argsort(-freq, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        seen = list(self.numbers)
        words = [seen[i] for i in order]
        part = np.fromiter((zlib.crc32(w) % parts for w in words), np.uint32, len(words))
        return words, rank[codes] if len(codes) else codes, part, self.print.intdigest() >> 1


def _blocks(batches: Iterator[pa.RecordBatch], lower: bool, counted) -> Iterator[_Block]:
    first = TaskContext.get().partitionId() << 32
    block, n = _Block(first), 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
            if block.doc_ids and block.size + len(text) > BLOCK_BYTES:
                yield block
                n += 1
                block = _Block(first + n)
            block.add(doc_id, text, lower, counted is None or counted(doc_id))
    if block.doc_ids:
        yield block


def requests(docs: DataFrame, parts: int, lower: bool = False, counted=None) -> DataFrame:
    """One row per block and part: its distinct words and how often each occurs in the documents for which
    ``counted(doc_id)`` holds (all, if not given)."""

    def run(batches):
        for block in _blocks(batches, lower, counted):
            words, codes, part, mark = block.close(parts)
            if counted is None:
                freq = np.bincount(codes, minlength=len(words))
            else:
                freq = np.bincount(codes[np.repeat(block.weight, block.sizes)], minlength=len(words))
            order = np.argsort(part, kind="stable")
            asked = np.unique(part)
            out = {"part": [], "block": [], "fingerprint": [], "words": [], "counts": []}
            for p, own in zip(asked, np.split(order, np.searchsorted(part[order], asked[1:])), strict=False):
                out["part"].append(int(p))
                out["block"].append(block.number)
                out["fingerprint"].append(mark)
                out["words"].append(pack_words([words[i] for i in own]))
                out["counts"].append(pack(freq[own]))
            yield pa.RecordBatch.from_pydict(out, schema=arrow(REQUESTS))

    return docs.select("doc_id", "text").mapInArrow(run, REQUESTS)


def numbered(docs: DataFrame, parts: int, lower: bool = False) -> DataFrame:
    """One row per block: its documents as word numbers, and the part that each word was asked from."""

    def run(batches):
        for block in _blocks(batches, lower, None):
            _, codes, part, mark = block.close(parts)
            row = {
                "block": [block.number], "fingerprint": [mark], "doc_ids": [block.doc_ids], "sizes": [block.sizes],
                "codes": [pack(codes)], "parts": [pack(part)],
            }
            yield pa.RecordBatch.from_pydict(row, schema=arrow(NUMBERED))

    return docs.select("doc_id", "text").mapInArrow(run, NUMBERED)


def answered(numbered_row: dict, answers: pa.Table) -> tuple[list[dict], np.ndarray]:
    """The answer rows of a block by part, and for each word number its place in their concatenation."""
    rows = sorted(answers.to_pylist(), key=lambda r: r["part"])
    if any(r["fingerprint"] != numbered_row["fingerprint"] for r in rows):
        raise RuntimeError("the input gave other rows when it was read again; stage it first")
    part = unpack(numbered_row["parts"])
    if len(rows) != len(np.unique(part)):
        raise RuntimeError("the input gave other rows when it was read again; stage it first")
    order = np.argsort(part, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return rows, place


def arrow(ddl: str) -> pa.Schema:
    kinds = {
        "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(),
        "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
        "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])
