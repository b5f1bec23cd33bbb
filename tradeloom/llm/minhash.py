"""Near-duplicate documents by circulant MinHash, banding and exact verification.

1. A document's set are the hashes of its distinct ``SHINGLE``-word shingles. Documents with equal sets form a
   class; all further work is on one document per class, so a large group of copies costs one row.
2. Signature: sigma and pi are two permutations of the 32-bit numbers, and coordinate k of a set is the
   least pi(sigma(x) + k) over its members: one permutation in place of ``COORDINATES``, shifted around
   the circle. ``ROWS`` coordinates make a band. A pair at the threshold misses all bands with a chance of
   (1 - 0.75^3)^24, 2 in a million.
3. Classes that agree in a band are compared by their signatures within the band's bucket, and only the edges
   that join two parts of it are passed on, so a bucket of n rows yields fewer than n. Buckets above ``MEMBERS``
   rows are split, and their pieces are joined without comparison, which can only add candidates.
4. Within each component of the candidates the true sets are compared, and documents are joined when they
   pass the threshold. A component too large for a task is dealt into pieces that all hold its first member, and
   what no piece has linked to that one is then compared with all pieces.

Results: a document without words has an empty set and is linked with nothing. A null ``doc_id`` counts as larger
than every other; a component of such documents only has a null id, and all of them are kept. Repeated rows are
copies of each other. Other columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import WordHash, groups, keyed, mixed, partitions, sequences, stage
from tradeloom.llm.graph import components
from tradeloom.llm.wordblocks import arrow, texts_of

SHINGLE = 5
PERCENT = 75
ROWS, BANDS = 3, 24
COORDINATES = ROWS * BANDS
#: A pair at the threshold agrees in fewer coordinates with a chance below 1 in a million.
AGREEING = 34
#: Rows that one task compares at once, and characters of their texts.
MEMBERS, CHARS = 2048, 16 << 20
NO_ID = (1 << 63) - 1
SHINGLES_AT_ONCE = 1 << 19

SETS = "doc_id bigint, text_hash bigint, n_shingles bigint, v bigint, signature binary"
BUCKETS = "bucket bigint, v bigint"
EDGES = "a bigint, b bigint"


def shingles(text: bytes, hashes: WordHash) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted. Fewer words than a shingle are one together."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    of = hashes.of(words)
    if len(of) < SHINGLE:
        return mixed(sequences(of, len(of)) + np.uint64(len(of)))
    return np.unique(sequences(of, SHINGLE))


def _spread(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of coordinates for each set; none of them is empty."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    sigma = _spread(x, 0x7FEB352D, 0x846CA68B)
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for k in range(COORDINATES):
        pi = _spread(sigma + np.uint32(k), 0x21F0AAAD, 0xD35A2D97)
        out[:, k] = np.minimum.reduceat(pi, starts)
    return out


def _sets(docs: DataFrame) -> DataFrame:
    def run(batches):
        hashes = WordHash()
        for batch in batches:
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            rows, size = [], 0
            for doc_id, mark, text in zip(ids, marks, texts_of(batch), strict=True):
                rows.append((doc_id, mark, shingles(text, hashes)))
                size += len(rows[-1][2])
                if size > SHINGLES_AT_ONCE:
                    yield _set_rows(rows)
                    rows, size = [], 0
            if rows:
                yield _set_rows(rows)

    return docs.mapInArrow(run, SETS)


def _set_rows(rows: list[tuple]) -> pa.RecordBatch:
    full = [s for _, _, s in rows if len(s)]
    signed = iter(signatures(full)) if full else iter(())
    out = {
        "doc_id": [r[0] for r in rows],
        "text_hash": [r[1] for r in rows],
        "n_shingles": [len(r[2]) for r in rows],
        "v": [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())))) if len(s) else None for _, _, s in rows],
        "signature": [next(signed).tobytes() if len(s) else None for _, _, s in rows],
    }
    return pa.RecordBatch.from_pydict(out, schema=arrow(SETS))


def _buckets(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            signed = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32)
            bands = signed.reshape(-1, BANDS, ROWS).astype(np.uint64)
            v = batch.column("v").to_numpy()
            for band in range(BANDS):
                key = sequences_of_three(bands[:, band], band)
                yield pa.RecordBatch.from_pydict({"bucket": key.view(np.int64), "v": v}, schema=arrow(BUCKETS))

    return classes.select("v", "signature").mapInArrow(run, BUCKETS)


def sequences_of_three(rows: np.ndarray, band: int) -> np.ndarray:
    """One 64-bit key for each row of a band, another for each band."""
    key = mixed(rows[:, 0] + np.uint64(band << 32))
    for i in range(1, rows.shape[1]):
        key = mixed(key ^ mixed(rows[:, i] + np.uint64(i << 40)))
    return key


class Parts:
    """Disjoint sets."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> np.ndarray:
        """Join i with each of the others; gives those that were apart, one of each part."""
        labels, first = np.unique(self.of[others], return_index=True)
        apart = labels != self.of[i]
        if apart.any():
            self.of[np.isin(self.of, labels[apart])] = self.of[i]
        return others[first[apart]]


def _candidates(members: DataFrame, n: int) -> DataFrame:
    """Edges that span the parts of each bucket whose signatures agree."""

    def run(batches):
        for rows in groups(batches, ["bucket", "piece"]):
            v = rows.column("v").to_numpy()
            signed = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            parts, edges = Parts(len(v)), []
            for i in range(len(v)):
                rest = np.flatnonzero(parts.of != parts.of[i])
                if not len(rest):
                    break
                near = rest[(signed[rest] == signed[i]).sum(1) >= AGREEING]
                edges += [(int(v[i]), int(v[j])) for j in parts.join(i, near)] if len(near) else []
            if rows.column("n")[0].as_py() > MEMBERS:
                first = rows.column("least")[0].as_py()
                edges += [(int(v[np.argmax(parts.of == p)]), first) for p in np.unique(parts.of)]
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.RecordBatch.from_pydict({"a": a, "b": b}, schema=arrow(EDGES))

    dealt = members.repartition(n, "bucket", "piece").sortWithinPartitions("bucket", "piece", "v")
    return dealt.mapInArrow(run, EDGES)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets pass the threshold."""
    least, most = sorted((len(a), len(b)))
    if 100 * least < PERCENT * most:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def exact_edges(sets: list[np.ndarray], asking: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the parts which links between an asking set and any set make."""
    n, parts, edges = len(sets), Parts(len(sets)), []
    sizes = np.array([len(s) for s in sets])
    if n <= 8:
        for i in np.flatnonzero(asking):
            for j in range(n):
                if parts.of[i] != parts.of[j] and linked(sets[i], sets[j]):
                    edges += [(i, int(k)) for k in parts.join(i, np.array([j]))]
        return edges
    # an inverted index: members of the sets as columns, the sets that hold them as entries
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(column, kind="stable")
    entries, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(column))])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    for i in np.flatnonzero(asking):
        rest = (parts.of != parts.of[i]) & (100 * np.minimum(sizes, sizes[i]) >= PERCENT * np.maximum(sizes, sizes[i]))
        if not rest.any():
            continue
        own = column[begins[i] : begins[i + 1]]
        lengths = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        both = np.bincount(entries[at], minlength=n)
        near = np.flatnonzero(rest & (100 * both >= PERCENT * (sizes + sizes[i] - both)))
        if len(near):
            edges += [(int(i), int(j)) for j in parts.join(int(i), near)]
    return edges


def _exact(rows: DataFrame, n: int) -> DataFrame:
    """Edges among the texts of each (root, piece); a pair counts where one of the two asks."""

    def run(batches):
        hashes = WordHash()
        for group in groups(batches, ["root", "piece"]):
            v, asks = group.column("v").to_numpy(), np.array(group.column("asks").to_pylist())
            order = np.lexsort((~asks, v))
            order = order[np.unique(v[order], return_index=True)[1]]  # each text once, as one that asks if it does
            v = v[order]
            edges = exact_edges([shingles(t, hashes) for t in texts_of(group.take(order))], asks[order])
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.RecordBatch.from_pydict({"a": v[list(a)], "b": v[list(b)]}, schema=arrow(EDGES))

    columns = ["root", "piece", "v", "asks", "text"]
    dealt = rows.select(*columns).repartition(n, "root", "piece").sortWithinPartitions("root", "piece")
    return dealt.mapInArrow(run, EDGES)


def _verified(texts: DataFrame, n: int) -> DataFrame:
    """(v, root) of the true components among candidate components (root, v, text)."""
    sizes = texts.groupBy("root").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.min("v").alias("first")
    )
    pieces = F.ceil(F.greatest(F.col("n") / MEMBERS, F.col("chars") / CHARS)).cast("int")
    sizes = stage(sizes.withColumn("pieces", pieces), "candidate-sizes")
    rows = texts.join(sizes, "root").withColumn("asks", F.lit(True))
    dealt = rows.withColumn("piece", F.pmod(F.xxhash64("v"), "pieces").cast("int"))
    # the first member goes to all pieces of a component that has several
    first = rows.filter("v = first and pieces > 1").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    edges = stage(_exact(dealt.filter("pieces = 1 or v <> first").unionByName(first), n), "links")
    split = sizes.filter("pieces > 1")
    if split.isEmpty():
        return components(edges)
    # what isn't linked to the first member of a split component: compare it with the whole component
    found = components(edges)
    whole = rows.filter("pieces > 1")
    main = found.join(split.select(F.col("first").alias("v")), "v").select(F.col("root").alias("main"))
    inside = found.join(main, found["root"] == main["main"], "left_semi").select("v")
    rest = stage(whole.join(inside, "v", "left_anti").select("root", "v", "text", "pieces"), "unlinked")
    if rest.isEmpty():
        return found
    # in blocks: each (piece, block) holds a piece of the component, and a block of the texts that ask
    counts = rest.groupBy("root").agg(F.count(F.lit(1)).alias("k"), F.sum(F.length("text")).alias("chars"))
    blocks = F.ceil(F.greatest(F.col("k") / MEMBERS, F.col("chars") / CHARS)).cast("int")
    counts = counts.select("root", blocks.alias("blocks"))
    place = (F.col("piece") * F.lit(1 << 20) + F.col("block")).alias("piece")
    columns = ["root", place, "v", "asks", "text"]
    own = F.pmod(F.xxhash64("v", F.lit(1)), "blocks").cast("int")
    asking = rest.join(counts, "root").withColumn("block", own).withColumn("asks", F.lit(True))
    asking = asking.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(*columns)
    asked = whole.join(counts, "root").withColumn("piece", F.pmod(F.xxhash64("v"), "pieces").cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    within = asking.unionByName(asked.withColumn("asks", F.lit(False)).select(*columns))
    return components(edges.union(_exact(within, n)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), n_shingles, component_id (the least doc_id reachable over links) and
    kept, one row per document."""
    return with_components(docs).drop("component")


def with_components(docs: DataFrame) -> DataFrame:
    """`near_duplicates` and ``component``, which tells components apart whatever their ids; null without words."""
    n = partitions(docs.sparkSession)
    rows = keyed(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    sets = stage(_sets(rows), "shingle-sets")
    classes = sets.filter("v is not null").groupBy("v").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash", "signature")).alias("one")
    )
    classes = stage(classes.select("v", "least", "one.*"), "shingle-classes")

    buckets = _buckets(classes)
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least")).filter("n > 1")
    members = buckets.join(shared, "bucket").join(classes.select("v", "signature"), "v")
    piece = F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / MEMBERS)).cast("int")
    near = components(_candidates(members.withColumn("piece", piece), n))

    chosen = near.join(classes.select("v", "doc_id", "text_hash"), "v")
    texts = rows.join(chosen, ["doc_id", "text_hash"]).select("root", "v", "text")
    found = stage(_verified(stage(texts.dropDuplicates(["v"]), "candidate-texts"), n), "components")

    least = found.join(classes.select("v", "least"), "v").groupBy("root").agg(F.min("least").alias("component_id"))
    moved = found.join(least, "root").select("v", "root", "component_id")
    of = classes.select("v", "least").join(moved, "v", "left")
    # A table of its own: the join with a class that holds most documents is then one that Spark can split.
    of = of.select("v", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "v").alias("component"))
    of = stage(of, "class-components")
    out = sets.select("doc_id", "text_hash", "n_shingles", "v").join(of, "v", "left")
    least = F.coalesce("component_id", "doc_id")
    return out.select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
        "text_hash",
        "n_shingles",
        F.when(least != NO_ID, least).alias("component_id"),
        (F.col("doc_id") == least).alias("kept"),
        "component",
    )
