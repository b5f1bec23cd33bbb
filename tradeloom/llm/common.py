"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.storage import shared_root

#: ASCII white space; everything else belongs to a word. ``bytes.split()`` cuts at the same six characters.
SPACE = "\\x20\\x09-\\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the key and the text under fixed names, whatever else the table holds; a null text stays null."""
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` to the shared folder and read them back: later steps start from files that every
    executor can reach, whatever is lost meanwhile."""
    spark = rows.sparkSession
    path = f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for a null text."""
    cut = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.filter(cut, lambda w: w != "")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, as a lambda's argument is, and not once per mention."""
    return F.transform(F.array(value), use)[0]


class WordHash(dict):
    """word -> 64-bit hash; forgets what it knows when it grows too large."""

    KEPT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.KEPT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sequences(hashes: np.ndarray, size: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive words, from the words' hashes.

    The polynomial in ``base``, put together from the sequences of 1, 2, 4, ... words, and mixed.
    """
    n = len(hashes) - size + 1
    if n < 1:
        return hashes[:0]
    with np.errstate(over="ignore"):
        power, length, part = np.uint64(base), 1, hashes
        out, have = None, 0  # the hash of the first ``have`` words
        while True:
            if size & length:
                if out is None:
                    out = part[:n] if size == length else part.copy()
                else:
                    out = out[: len(hashes) - have - length + 1] * power + part[have : have + len(out)][: len(hashes) - have - length + 1]
                have += length
                if have == size:
                    return mixed(out[:n])
            part = part[:-length] * power + part[length:]
            power, length = power * power, length * 2


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that are sorted by ``keys`` (whole numbers), one by one; holds one group and one batch."""
    held: list[pa.RecordBatch] = []

    def key(batch, i):
        return tuple(batch.column(k)[i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            column = batch.column(k).to_numpy(zero_copy_only=False)
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        if held and key(held[0], 0) != key(batch, 0):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)
