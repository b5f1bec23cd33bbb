"""Removing long passages that an earlier document already holds, found by recompression.

Texts are sequences of words. A round of recompression replaces each maximal run of one symbol by a new symbol, then
each pair of neighbours whose left one is marked L and whose right one is marked R. New symbols are named, and marked,
by a hash of what they replace, so every task of every machine names alike and no naming table is shuffled. Whether
symbols are joined depends only on themselves, and so equal substrings are parsed alike but for their ends. What is
lost at the ends can be told from the substring alone: in every round its first and its last run (they may go on
outside), then a first symbol marked R and a last one marked L (they may be joined to their neighbours outside). The
symbols left after ``ROUNDS`` rounds lie in every occurrence of the substring, whatever surrounds it.

1. Each window of ``WINDOW`` words names one of these symbols, the one of least hash, with the words next to it, as its
   anchor; neighbouring windows mostly name the same one. A window of runs alone, in which no symbol outlives a
   round, names one of an earlier round. Equal windows have equal anchors.
2. Anchors are counted by distinct text. Only windows whose anchor occurs in two texts can be repeated.
3. Those windows are compared by a 128-bit hash of their words: the least document that holds each is found, and the
   words that it covers in later documents are removed.

Documents with the same words are one text up to here, so a large group of copies costs one row: all of them but the
first lose all their words, if they have ``WINDOW`` of them. Anchors and windows of a passage that many documents share
are pre-aggregated, and the joins back are plain ones, which Spark splits when they are skewed.

A null text has no words. A null ``doc_id`` counts as larger than every other, and such documents don't repeat each
other; nor do rows with one ``doc_id``. Other columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import SPACE, WordHash, keyed, mixed, sequences, stage
from tradeloom.llm.wordblocks import arrow, texts_of

WINDOW = 50
ROUNDS = 3
#: A round takes at least one symbol from either end of a window, so these words lie in it with each anchor.
BESIDE = ROUNDS
WORDS_AT_ONCE = 1 << 19
NO_ID = (1 << 63) - 1
SECOND = 0xD6E8FEB86659FD93

TEXTS = "doc_id bigint, text_hash bigint, n_words bigint, v bigint, sha string, anchors array<bigint>"
WINDOWS = "h bigint, g bigint, doc_id bigint, v bigint"
KEPT = "v bigint, n_removed bigint, kept_sha string, kept_text string"

_WORD = re.compile(rb"[^%s]+" % SPACE.encode())


class Level:
    """One round's parse of many texts strung together: names and first words of the symbols."""

    def __init__(self, names: np.ndarray, starts: np.ndarray, texts: np.ndarray):
        self.names, self.starts, self.texts = names, starts, texts

    def runs(self) -> tuple[Level, np.ndarray]:
        """Runs replaced by symbols, and the run that each symbol went into."""
        fresh = np.ones(len(self.names), bool)
        fresh[1:] = (self.names[1:] != self.names[:-1]) | (self.texts[1:] != self.texts[:-1])
        first = np.flatnonzero(fresh)
        length = np.diff(np.append(first, len(self.names))).astype(np.uint64)
        names = self.names[first]
        names = np.where(length > 1, mixed(names + np.uint64(0xA5) * length), names)
        return Level(names, self.starts[first], self.texts[first]), np.cumsum(fresh) - 1

    def marks(self, r: int) -> np.ndarray:
        """True for L."""
        return (mixed(self.names ^ np.uint64(0x51ED2701 + r)) & np.uint64(1)).astype(bool)

    def pairs(self, r: int) -> tuple[Level, np.ndarray, np.ndarray]:
        """Pairs LR replaced by symbols, the symbol that each symbol went into, and the marks."""
        left = self.marks(r)
        joined = np.zeros(len(self.names), bool)  # to the symbol before
        joined[1:] = left[:-1] & ~left[1:] & (self.texts[1:] == self.texts[:-1])
        first = np.flatnonzero(~joined)
        names = self.names[first]
        pair = np.zeros(len(self.names) + 1, bool)
        pair[:-1] = joined
        two = pair[first + 1]
        other = self.names[np.minimum(first + 1, len(self.names) - 1)]
        with np.errstate(over="ignore"):
            names = np.where(two, mixed(names * np.uint64(3) + mixed(other)), names)
        return Level(names, self.starts[first], self.texts[first]), np.cumsum(~joined) - 1, left


def _least_in(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each range [a, b), none empty, the place of its least value."""
    best = a.copy()
    for k in range(1, int((b - a).max(initial=0))):
        at = a + k
        inside = np.flatnonzero(at < b)
        if not len(inside):
            break
        smaller = values[at[inside]] < values[best[inside]]
        best[inside[smaller]] = at[inside[smaller]]
    return best


def anchors(hashes: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, the anchor of each of its windows (none, if it is shorter than one)."""
    sizes = np.array([len(h) for h in hashes])
    words = np.concatenate(hashes)
    texts = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    first = np.arange(len(words))
    first = first[first + WINDOW <= ends[texts]]  # the windows
    a, b = first.copy(), first + WINDOW  # symbols of the level that are sure to lie in the window
    out = np.zeros(len(first), np.uint64)
    open_ = np.arange(len(first))  # windows that still hold a symbol
    level = Level(words, np.arange(len(words)), texts)
    for r in range(ROUNDS + 1):
        if r < ROUNDS:
            run, into = level.runs()
            x, y = into[a] + 1, into[b - 1]
            following, into, left = run.pairs(r)
            some = x < y
            x, y = np.where(some, x, 0), np.where(some, y, 1)
            x, y = x + ~left[x], y - left[y - 1]
            some &= x < y
            spent = np.flatnonzero(~some)
        else:
            spent = np.arange(len(open_))
        if len(spent):  # these end at this level
            at = _least_in(mixed(level.names), a[spent], b[spent])
            starts = level.starts[at]
            stops = np.append(level.starts, len(words))[at + 1]
            out[open_[spent]] = _named(words, starts, stops, level.names[at], r)
        if r == ROUNDS:
            break
        keep = np.flatnonzero(some)
        open_, a, b = open_[keep], into[x[keep]], into[y[keep] - 1] + 1
        level = following
    cuts = np.searchsorted(texts[first], np.arange(1, len(sizes)))
    return np.split(out, cuts)


def _named(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, names: np.ndarray, r: int) -> np.ndarray:
    """The anchor: a symbol of round r with as many words on either side as every window with it holds."""
    with np.errstate(over="ignore"):
        out = mixed(names + np.uint64(r))
        for k in range(1, min(r, BESIDE) + 1):
            out = mixed(out * np.uint64(5) + words[starts - k])
            out = mixed(out * np.uint64(7) + words[stops + k - 1])
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    """What is known of each text from one reading, its anchors included; of equal texts read together, one has them."""

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            rows, size = [], 0
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            for doc_id, mark, text in zip(ids, marks, texts_of(batch), strict=True):
                words = text.split()
                rows.append((doc_id, mark, hashes.of(words), hashlib.sha256(b" ".join(words)).hexdigest()))
                size += len(words)
                if size > WORDS_AT_ONCE:
                    yield described(rows)
                    rows, size = [], 0
            yield described(rows)

    def described(rows: list[tuple]) -> pa.RecordBatch:
        v = [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(of.tobytes())))) for _, _, of, _ in rows]
        first = {x: i for i, x in reversed(list(enumerate(v))) if len(rows[i][2]) >= WINDOW}
        found: list = [[]] * len(rows)
        if first:
            for i, x in zip(first.values(), anchors([rows[i][2] for i in first.values()]), strict=True):
                found[i] = _signed(np.unique(x))
        out = {"doc_id": [r[0] for r in rows], "text_hash": [r[1] for r in rows], "n_words": [len(r[2]) for r in rows]}
        out |= {"v": v, "sha": [r[3] for r in rows], "anchors": found}
        return pa.RecordBatch.from_pydict(out, schema=arrow(TEXTS))

    return docs.mapInArrow(run, TEXTS)


def _hashes(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return sequences(of, WINDOW), sequences(of, WINDOW, SECOND)


def _windows(texts: DataFrame) -> DataFrame:
    """The distinct windows of each text whose anchors other texts have too."""

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            for row in batch.to_pylist():
                of = hashes.of(row["text"].encode().split())
                shared = np.isin(anchors([of])[0], np.array(row["anchors"], np.int64).view(np.uint64))
                h, g = (x[shared] for x in _hashes(of))
                _, one = np.unique(h, return_index=True)
                out = {"h": _signed(h[one]), "g": _signed(g[one])}
                out |= {k: np.full(len(one), row[k], np.int64) for k in ("doc_id", "v")}
                yield pa.RecordBatch.from_pydict(out, schema=arrow(WINDOWS))

    return texts.select("doc_id", "v", "text", "anchors").mapInArrow(run, WINDOWS)


def _without(texts: DataFrame) -> DataFrame:
    """The texts without the words of the windows listed in ``repeated``."""

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in KEPT.split(", ")}
            for row in batch.to_pylist():
                text = row["text"].encode()
                words = text.split()
                hit = np.isin(sequences(hashes.of(words), WINDOW), np.array(row["repeated"], np.int64).view(np.uint64))
                step = np.zeros(len(words) + 1, np.int64)
                step[: len(hit)] += hit
                step[WINDOW : WINDOW + len(hit)] -= hit
                gone = np.cumsum(step[:-1]) > 0
                stay = (~gone).tolist()
                kept = b" ".join([w for w, s in zip(words, stay, strict=True) if s])
                # a removed word takes the white space after it along
                starts = [m.start() for m in _WORD.finditer(text)]
                pieces = zip(starts, [*starts[1:], len(text)], stay, strict=True)
                left = text[: starts[0]] + b"".join([text[x:y] for x, y, s in pieces if s])
                row = (row["v"], int(gone.sum()), hashlib.sha256(kept).hexdigest(), left.decode())
                for k, x in zip(out, row, strict=True):
                    out[k].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=arrow(KEPT))

    return texts.select("v", "text", "repeated").mapInArrow(run, KEPT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, n_removed, kept_sha256 and, where words were removed, kept_text."""
    rows = keyed(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    read = stage(_texts(rows), "texts")
    texts = read.drop("anchors")
    first = texts.filter(F.col("n_words") >= WINDOW).groupBy("v").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
    first = first.select("v", "one.*")

    found = read.select("v", F.explode("anchors").alias("anchor"))
    shared = found.groupBy("anchor").agg(F.min("v").alias("x"), F.max("v").alias("y")).filter("x < y").select("anchor")
    lists = found.join(shared, "anchor").dropDuplicates(["v", "anchor"])
    lists = lists.groupBy("v").agg(F.collect_list("anchor").alias("anchors")).join(first, "v")
    candidates = rows.join(lists, ["doc_id", "text_hash"]).dropDuplicates(["v"])
    candidates = stage(candidates.select("v", "doc_id", "text", "anchors"), "candidates")

    windows = stage(_windows(candidates), "windows")
    least = windows.groupBy("h", "g").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    later = windows.join(least.filter("least < most"), ["h", "g"]).filter("doc_id > least")
    repeated = later.groupBy("v").agg(F.collect_list("h").alias("repeated"))
    kept = _without(candidates.select("v", "text").join(repeated, "v"))

    # A table of its own: the join with a text that most documents share is then one that Spark can split.
    by_text = stage(first.select("v", F.col("doc_id").alias("first")).join(kept, "v", "left"), "results")
    out = texts.join(by_text, "v", "left")
    copy = F.col("doc_id") > F.col("first")
    return out.select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
        "text_hash",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
