"""Approximate nearest neighbours with an inverted multi-index.

1. Equal vectors form a class. A class is indexed once and carries its ``top + 1`` least ids, which are all that an answer
   can need, so a vector that a third of the rows hold costs one entry, and no answer changes.
2. Each half of the vectors is quantised on its own; a pair of centroids is a cell. Codebooks come from a sample of at
   most ``SAMPLE`` classes; every class is put into its cell.
3. A query sorts the centroids of either half by distance, and a heap yields the pairs in order of the summed distance,
   until the cells taken hold enough classes. How many are enough is measured: on the sample, against brute force, so
   that a share ``TARGET`` of the true neighbours is found. Vectors without structure need a large share of
   all cells, clustered ones a small share.
4. Cells are dealt into buckets of about ``BUCKET`` classes, large cells into several. Queries travel to the buckets
   of their cells, once for each bucket, with the list of cells; distances are worked out there, in double
   precision on the original vectors, and only the best of each query and task go on.

Rows take no part whose id or vector is null, or whose vector is zero, holds a null or non-finite component, or is of
another length than most: such a vector is neither query nor candidate. Vectors of one component are searched too. Rows
with one id and vector are one; a query is no candidate of its own. Queries with fewer than ``top`` candidates get them
all; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import partitions, stage
from tradeloom.llm.wordblocks import arrow

SAMPLE, SAMPLE_QUERIES = 20_000, 256
#: Classes a cell should hold, on average, and the most centroids of a half.
IN_CELL, MOST_CENTROIDS = 32, 1024
ROUNDS = 12
TARGET = 0.97
BUCKET = 4096
HELD_QUERIES = 20_000

VECTORS = "a bigint, b bigint, vec_id bigint, vector binary"
CLASSES = "a bigint, b bigint, vector binary, ids array<bigint>"
CELLS = "bucket bigint, kind int, a bigint, b bigint, vector binary, cells array<int>, ids array<bigint>"
FOUND = "a bigint, b bigint, ids array<bigint>, distances array<double>"


def _vectors(rows: DataFrame, dim: int) -> DataFrame:
    """Valid vectors in double precision, under a 128-bit hash of their bytes."""

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in VECTORS.split(", ")}
            flat = np.array(batch.column("v").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim) + 0.0
            good = np.isfinite(flat).all(1) & flat.any(1)
            for i in np.flatnonzero(good):
                data = flat[i].tobytes()
                a, b = divmod(xxhash.xxh3_128_intdigest(data), 1 << 64)
                row = (a - (1 << 63), b - (1 << 63), batch.column("vec_id")[int(i)].as_py(), data)
                for k, x in zip(out, row, strict=True):
                    out[k].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=arrow(VECTORS))

    whole = rows.filter((F.size("v") == dim) & ~F.exists("v", lambda x: x.isNull()))
    return whole.mapInArrow(run, VECTORS)


def _classes(vectors: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector with its least ids. Each batch sends at most ``keep`` ids of a vector."""

    def run(batches):
        for batch in batches:
            own: dict[tuple, list] = {}
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "vec_id", "vector")]
            for a, b, i, data in zip(*columns, strict=True):
                own.setdefault((a, b, data), []).append(i)
            out = {k: [c[j] for c in own] for j, k in enumerate(("a", "b", "vector"))}
            out["ids"] = [sorted(set(ids))[:keep] for ids in own.values()]
            yield pa.RecordBatch.from_pydict(out, schema=arrow(CLASSES))

    some = vectors.mapInArrow(run, CLASSES)
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return some.groupBy("a", "b", "vector").agg(ids.alias("ids"))


def _square(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] + (c**2).sum(1)[None] - 2 * x @ c.T


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = x.shape[1] // 2
    return x[:, :cut], x[:, cut:]


def codebook(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly spread starts; the result depends on the rows alone."""
    centroids = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(ROUNDS):
        of = _square(x, centroids).argmin(1)
        counts = np.bincount(of, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, of, x)
        used = counts > 0
        centroids[used] = sums[used] / counts[used][:, None]
    return centroids


def traverse(near: np.ndarray, far: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells in order of summed distance (``near[i] + far[j]``), until they hold ``enough`` classes.

    ``counts`` is by cell, i * len(far) + j. A pair enters the heap when both pairs before it have been taken.
    """
    left, right = np.argsort(near, kind="stable").tolist(), np.argsort(far, kind="stable").tolist()
    x, y = near[left].tolist(), far[right].tolist()
    taken = [0] * len(left)  # how many of the second half's centroids each of the first half's has been paired with
    heap = [(x[0] + y[0], 0, 0)]
    cells, held = [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        taken[i] = j + 1
        cell = left[i] * len(right) + right[j]
        n = counts[cell]
        if n:
            cells.append(cell)
            held += n
        if i + 1 < len(left) and taken[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
        if j + 1 < len(right) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
    return cells


class Index:
    """Two codebooks, the share of the classes that a query looks at, and where the cells lie."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], share: float):
        self.books, self.share = books, share
        self.counts = self.first = self.pieces = None

    @classmethod
    def train(cls, sample: np.ndarray, n_classes: int, top: int) -> Index:
        k = int(np.clip(np.sqrt(n_classes / IN_CELL), 2, MOST_CENTROIDS))
        halves = _halves(sample)
        index = cls(tuple(codebook(h, k) for h in halves), 1.0)
        return cls(index.books, index.measure(sample, top))

    def cells(self, x: np.ndarray) -> np.ndarray:
        i, j = (_square(h, c).argmin(1) for h, c in zip(_halves(x), self.books, strict=True))
        return i * len(self.books[1]) + j

    def measure(self, sample: np.ndarray, top: int) -> float:
        """The share of the sample that queries must look at to find ``TARGET`` of their true neighbours."""
        asked = np.linspace(0, len(sample) - 1, min(SAMPLE_QUERIES, len(sample))).astype(int)
        of = self.cells(sample)
        needed = []
        for q in asked:
            d = _square(sample[q : q + 1], sample)[0]
            d[q] = np.inf
            true = np.argsort(d, kind="stable")[:top]
            true = true[true != q]
            near, far = self.to_centroids(sample[q])
            way = (near[:, None] + far[None]).ravel()[of]
            needed += [(way <= way[t]).mean() for t in true]
        return float(np.quantile(needed, TARGET)) if needed else 1.0

    def to_centroids(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(_square(h, c)[0] for h, c in zip(_halves(q[None]), self.books, strict=True))

    def lay_out(self, counts: np.ndarray) -> None:
        """Deal cells into buckets: neighbours share one, and large cells have several."""
        self.counts = counts
        self.pieces = np.maximum(1, -(-counts // BUCKET)).astype(np.int64)
        self.first = np.zeros(len(counts), np.int64)
        bucket, held = 0, 0
        for cell in np.flatnonzero(counts):
            n = int(counts[cell])
            if held and held + n > BUCKET:
                bucket, held = bucket + 1, 0
            self.first[cell] = bucket
            if self.pieces[cell] > 1:
                bucket, held = bucket + int(self.pieces[cell]), 0
            else:
                held += n


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _numbered(classes: DataFrame, index: Index, dim: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            cells = index.cells(_matrix(batch.column("vector"), dim)) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict({"cell": cells}, schema=arrow("cell bigint"))

    return classes.select("vector").mapInArrow(run, "cell bigint")


def _placed(classes: DataFrame, index: Index, dim: int) -> DataFrame:
    """Classes in their buckets."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = index.cells(_matrix(batch.column("vector"), dim))
            piece = batch.column("a").to_numpy().view(np.uint64) % index.pieces[cells].astype(np.uint64)
            out = {k: batch.column(k) for k in ("a", "b", "vector", "ids")}
            out |= {"bucket": index.first[cells] + piece.astype(np.int64), "kind": np.zeros(len(cells), np.int32)}
            yield pa.RecordBatch.from_pydict(out | {"cells": [[c] for c in cells]}, schema=arrow(CELLS))

    return classes.mapInArrow(run, CELLS)


def _asked(queries: DataFrame, index: Index, enough: int, dim: int) -> DataFrame:
    """Query vectors at the buckets of the cells that they look at."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "vector")]
            for a, b, data in zip(*columns, strict=True):
                near, far = index.to_centroids(np.frombuffer(data, np.float64))
                at: dict[int, list[int]] = {}
                for cell in traverse(near, far, index.counts, enough):
                    for piece in range(int(index.pieces[cell])):
                        at.setdefault(int(index.first[cell]) + piece, []).append(cell)
                n = len(at)
                out = {"bucket": list(at), "kind": [1] * n, "a": [a] * n, "b": [b] * n, "vector": [data] * n}
                yield pa.RecordBatch.from_pydict(out | {"cells": list(at.values()), "ids": [[]] * n}, schema=arrow(CELLS))

    return queries.mapInArrow(run, CELLS)


class _Best:
    """The nearest ids of each query so far."""

    def __init__(self, keep: int):
        self.keep, self.of = keep, {}

    def add(self, query: tuple, distances: np.ndarray, ids: np.ndarray) -> None:
        if query in self.of:
            d, i = self.of[query]
            distances, ids = np.concatenate([d, distances]), np.concatenate([i, ids])
        if len(distances) > self.keep:  # ties with the last one are told apart by id
            near = distances <= np.partition(distances, self.keep - 1)[self.keep - 1]
            distances, ids = distances[near], ids[near]
        order = np.lexsort((ids, distances))[: self.keep]
        self.of[query] = distances[order], ids[order]

    def rows(self) -> pa.RecordBatch:
        out = {"a": [q[0] for q in self.of], "b": [q[1] for q in self.of]}
        out |= {"ids": [i for _, i in self.of.values()], "distances": [d for d, _ in self.of.values()]}
        self.of = {}
        return pa.RecordBatch.from_pydict(out, schema=arrow(FOUND))


def _searched(cells: DataFrame, n: int, dim: int, keep: int) -> DataFrame:
    """Within each bucket, classes come first and are held; queries stream past them."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        best, bucket = _Best(keep), None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "kind", "a", "b", "vector", "cells", "ids")]
            for at, kind, a, b, data, own, ids in zip(*columns, strict=True):
                if at != bucket:
                    bucket, held, block = at, [], None
                if kind == 0:
                    held.append((own[0], data, ids))
                    continue
                if block is None:
                    block = np.frombuffer(b"".join(h[1] for h in held), np.float64).reshape(-1, dim)
                    of_cell = np.array([h[0] for h in held], np.int64)
                    lengths = np.array([len(h[2]) for h in held], np.int64)
                    all_ids = np.array([i for h in held for i in h[2]], np.int64)
                    starts = np.cumsum(lengths) - lengths
                rows = np.flatnonzero(np.isin(of_cell, own))
                if not len(rows):
                    continue
                d = np.sqrt(((block[rows] - np.frombuffer(data, np.float64)) ** 2).sum(1))
                if len(d) > keep:
                    near = d <= np.partition(d, keep - 1)[keep - 1]
                    rows, d = rows[near], d[near]
                long = lengths[rows]
                at_id = np.repeat(starts[rows] - np.cumsum(long) + long, long) + np.arange(long.sum())
                best.add((a, b), np.repeat(d, long), all_ids[at_id])
            if len(best.of) > HELD_QUERIES:
                yield best.rows()
        yield best.rows()

    return cells.repartition(n, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(run, FOUND)


def search(rows: DataFrame, asks, top: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score (the distance) of the nearest found; ``asks(id)`` tells which rows are queries."""
    spark, keep = rows.sparkSession, top + 1
    n = partitions(spark)
    result = "query_id bigint, rank int, vec_id bigint, score double"
    rows = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.filter("vec_id is not null and v is not null")
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim"))
    common = dims.filter("dim >= 1").first()
    if common is None:
        return spark.createDataFrame([], result)
    dim = common["dim"]
    if dim == 1:  # a second component of zero changes no distance, and gives both halves a width
        rows = rows.filter(F.size("v") == 1).withColumn("v", F.array(F.get("v", F.lit(0)), F.lit(0.0)))
        dim = 2
    vectors = stage(_vectors(rows, dim), "vectors")
    classes = stage(_classes(vectors, keep), "vector-classes")
    total = classes.count()
    if not total:
        return spark.createDataFrame([], result)
    drawn = classes.select("a", "b", "vector").orderBy("a", "b").limit(SAMPLE).collect()  # at most SAMPLE rows
    index = Index.train(np.frombuffer(b"".join(r["vector"] for r in drawn), np.float64).reshape(-1, dim), total, top)
    counts = np.zeros(len(index.books[0]) * len(index.books[1]), np.int64)
    for r in _numbered(classes, index, dim).groupBy("cell").count().collect():  # a row per cell
        counts[r["cell"]] = r["count"]
    index.lay_out(counts)

    queries = vectors.filter(asks(F.col("vec_id"))).select("vec_id", "a", "b", "vector").dropDuplicates(["vec_id", "a", "b"])
    enough = max(10 * keep, int(np.ceil(index.share * total)))
    cells = _placed(classes, index, dim).union(_asked(queries.dropDuplicates(["a", "b"]).drop("vec_id"), index, enough, dim))
    found = _searched(cells, n, dim, keep)
    pairs = F.transform(F.arrays_zip("distances", "ids"), lambda x: F.struct(x["distances"].alias("score"), x["ids"].alias("vec_id")))
    best = found.select("a", "b", pairs.alias("near")).groupBy("a", "b").agg(F.flatten(F.collect_list("near")).alias("near"))
    best = best.select("a", "b", F.slice(F.array_sort("near"), 1, keep).alias("near"))
    own = queries.select(F.col("vec_id").alias("query_id"), "a", "b").join(best, ["a", "b"])
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    ranked = own.select("query_id", F.posexplode(F.slice(others, 1, top)).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
