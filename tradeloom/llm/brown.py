"""Scoring texts with a Brown class-based bigram model.

A word's probability is that of its class after the previous word's class, times that of the word in its class,
both with additive smoothing. Classes come from exchange clustering: words move to the class that most raises the
likelihood of the training text under the class bigrams.

* Every training token is counted. Words are counted by distinct word and block (`wordblocks`), so that a frequent
  word costs one row per block.
* Every training word moves by its own neighbours. A round counts, for each word, the classes that follow and precede
  it: each block counts for its distinct words, and the counts of a word meet in its part, where it takes the class of
  greatest gain. The driver holds the class matrix alone. All words of a round see the class matrix of its start, so a move
  doesn't depend on which words share a part. The gain of a word with more than a ``FREQUENT``-th of all tokens is worked out with
  its own tokens taken out of the matrix first; of others it is taken cell by cell. After each round the matrix is counted anew.
  A round that doesn't raise the likelihood is undone and repeated for half of the words, drawn by a hash of word and round, down
  to ``LEAST_MOVERS``. Rounds end
  when one gains less than ``GAIN`` of the information that neighbouring classes hold about each other.
* Rounds start from a clustering of fixed size on the driver: the ``top`` most frequent words, each for itself, and all
  others together with those that share their ending (``ENDINGS`` groups); its sweeps end when one moves nothing or
  gains less than ``SWEEP_GAIN`` of the information. Only words that training lacks keep the
  class of their ending.
* Texts are scored where their numbered words meet the counts of the block's distinct words.

A text is its words, then one end, which also stands before the first word. The end is a class of its own.
A word not seen in training has the probability left for unseen words of its class. A null text is empty
and scores its end only. A null ``doc_id`` is scored, but belongs to neither part: it is not learned from, and
``held_out`` is null. With no training text, all scores follow from smoothing alone. Repeated rows count and are
scored one by one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import keyed, mixed, partitions, stage
from tradeloom.llm.wordblocks import (
    PARTS_PER_PARTITION,
    answered,
    arrow,
    numbered,
    pack,
    requests,
    texts_of,
    unpack,
    unpack_words,
)

TOP_WORDS = 1000
ENDINGS = 64
CLASSES = 40
#: Added to each count: of a word in its class, and of a class after a class.
WORD_PRIOR, CLASS_PRIOR = 0.5, 0.1
FOLDS, HELD_OUT = 5, 1
KEPT_WORDS = 500_000
#: At most so many words are frequent, however large the corpus is.
FREQUENT = 1_000
FREQUENT_AT_ONCE = 64
GAIN, LEAST_MOVERS = 0.01, 1 / 8
SWEEP_GAIN = 0.001
#: Up to this count, gains are looked up.
SMALL = 16
CELLS_AT_ONCE = 1 << 15
PAIRS_AT_ONCE = 1 << 20

TOTALS = (
    "part int, block bigint, fingerprint bigint, words binary, totals binary, places binary, known bigint, "
    "marks binary, distinct bigint, tokens bigint, top array<string>, top_counts array<bigint>"
)
ANSWERS = "part int, block bigint, fingerprint bigint, classes binary"
CELLS = "part int, block bigint, classes binary, steps binary, counts binary"
SUMS = "part int, classes binary, steps binary, counts binary, pairs binary, distinct binary"
PAIRS = "item int, counts binary"
SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
    "score double, perplexity double"
)


def fold(doc_id: int | None) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % FOLDS


def in_training(doc_id: int | None) -> bool:
    return doc_id is not None and fold(doc_id) != HELD_OUT


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


class Items(dict):
    """word -> item: 0 the end, 1 to ``ENDINGS`` the groups of endings, then the frequent words."""

    def __init__(self, top: list[bytes]):
        super().__init__()
        self.top = {w: 1 + ENDINGS + i for i, w in enumerate(top)}

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        item = self.top.get(word)
        self[word] = item = 1 + ending(word) if item is None else item
        return item


def _totals(asked: DataFrame, top: int) -> DataFrame:
    """Each request with its words' counts in the whole corpus; the first row of a part also sums the part up."""

    def run(part: pa.Table) -> pa.Table:
        total: dict[bytes, int] = {}
        rows = part.to_pylist()
        for r in rows:
            for w, n in zip(unpack_words(r["words"]), unpack(r["counts"]).tolist(), strict=True):
                total[w] = total.get(w, 0) + n
        known = {w: total[w] for w in sorted(total) if total[w]}  # in whatever order the rows came
        best = sorted(known, key=lambda w: (-known[w], w))[:top]
        # the words of training by number, then the endings, for words that training lacks
        place = {w: i for i, w in enumerate(known)}
        out = []
        for i, r in enumerate(rows):
            mine = unpack_words(r["words"])
            at = (place[w] if w in place else len(known) + ending(w) for w in mine)
            packed = pack(np.fromiter(map(total.__getitem__, mine), np.uint64, len(mine)), 8)
            row = {k: r[k] for k in ("part", "block", "fingerprint", "words")} | {"totals": packed}
            row |= {"places": pack(np.fromiter(at, np.uint32, len(mine))), "known": len(known)}
            row |= {"distinct": 0, "tokens": 0, "top": [], "top_counts": []}
            if i == 0:
                row["marks"] = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known)).tobytes()
                row |= {"distinct": len(known), "tokens": sum(known.values())}
                row |= {"top": [w.decode() for w in best], "top_counts": [known[w] for w in best]}
            out.append(row)
        return pa.Table.from_pylist(out, schema=arrow(TOTALS))

    return asked.groupBy("part").applyInArrow(run, TOTALS)


def _pairs(train: DataFrame, top: list[bytes]) -> np.ndarray:
    """How often each item follows each item in the training texts: a matrix of fixed size."""
    n = 1 + ENDINGS + len(top)

    def count(batches):
        item, sums = Items(top), np.zeros(n * n, np.int64)
        waiting, size = [], 0

        def settle():
            flat = np.concatenate(waiting)
            sums[:] += np.bincount(flat[:-1] * n + flat[1:], minlength=n * n)
            # the end of one text also stands before the next, so texts can be strung together
            del waiting[:]
            waiting.append(np.zeros(1, np.int64))

        waiting.append(np.zeros(1, np.int64))
        for batch in batches:
            for text in texts_of(batch):
                words = text.lower().split()
                own = np.zeros(len(words) + 1, np.int64)
                own[:-1] = np.fromiter(map(item.__getitem__, words), np.int64, len(words))
                waiting.append(own)
                size += len(own)
                if size > PAIRS_AT_ONCE:
                    settle()
                    size = 0
        settle()
        matrix = sums.reshape(n, n)
        used = np.flatnonzero(matrix.any(axis=1))
        out = {"item": used.tolist(), "counts": [pack(matrix[i], 8) for i in used]}
        yield pa.RecordBatch.from_pydict(out, schema=arrow(PAIRS))

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(n, np.int64)
        for data in rows.column("counts").to_pylist():
            total += unpack(data, 8).astype(np.int64)
        return pa.Table.from_pydict({"item": rows.column("item")[:1], "counts": [total.tobytes()]}, schema=arrow(PAIRS))

    rows = train.mapInArrow(count, PAIRS).groupBy("item").applyInArrow(add, PAIRS).collect()
    matrix = np.zeros((n, n))
    for r in rows:  # one row per item, at most
        matrix[r["item"]] = np.frombuffer(r["counts"], np.int64)
    return matrix


def exchange(pairs: np.ndarray, classes: int, least: float = SWEEP_GAIN) -> np.ndarray:
    """A class for each item. Item 0 keeps class 0 for itself; the others move, sweep by sweep, until a sweep moves none
    or gains less than ``least`` of the classes' information.

    The likelihood under class bigrams is, up to a constant, the sum of f over the class pairs' counts less the sums
    of f over the classes' counts on either side, where f(x) = x log x.
    """
    n = len(pairs)
    classes = max(2, min(classes, n))
    of = np.concatenate([[0], 1 + np.arange(n - 1) % (classes - 1)])
    one = np.zeros((n, classes))
    one[np.arange(n), of] = 1
    after, before = pairs @ one, pairs.T @ one  # of each item: counts of the classes that follow and precede it
    both = one.T @ after
    out_n, in_n = both.sum(1), both.sum(0)
    item_out, item_in = pairs.sum(1), pairs.sum(0)

    def f(x):
        return x * np.log(np.maximum(x, 1))

    value = information(both)
    while True:
        moved = 0
        for w in range(1, n):
            a, own = of[w], pairs[w, w]
            right, left = after[w].copy(), before[w].copy()
            right[a] -= own
            left[a] -= own
            both[a, :] -= right
            both[:, a] -= left
            both[a, a] -= own
            out_n[a] -= item_out[w]
            in_n[a] -= item_in[w]
            d = np.diag(both)
            gain = (f(both + right) - f(both)).sum(1) + (f(both + left[:, None]) - f(both)).sum(0)
            gain += f(d + right + left + own) - f(d + right) - f(d + left) + f(d)
            gain -= f(out_n + item_out[w]) - f(out_n) + f(in_n + item_in[w]) - f(in_n)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            b = a if gain[b] <= gain[a] + 1e-9 else b
            both[b, :] += right
            both[:, b] += left
            both[b, b] += own
            out_n[b] += item_out[w]
            in_n[b] += item_in[w]
            if a != b:
                of[w] = b
                moved += 1
                for table, column in ((after, pairs[:, w]), (before, pairs[w, :])):
                    table[:, a] -= column
                    table[:, b] += column
        before_it, value = value, information(both)
        if not moved or value - before_it < least * abs(before_it):
            return of


def _f(x):
    return x * np.log(np.maximum(x, 1))


def information(both: np.ndarray) -> float:
    """What neighbouring classes tell about each other, over all pairs: the likelihood up to a constant."""
    return float(_f(both).sum() - _f(both.sum(1)).sum() - _f(both.sum(0)).sum() + _f(both.sum()))


def moves(both: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The class that each word gains most by: ``right`` and ``left`` count the classes beside it, ``own`` itself."""
    before, of = of, of.copy()
    size, classes = right.sum(1), len(both)
    often = size * FREQUENT > both.sum()
    frequent = np.flatnonzero(often)
    for w in (frequent[i : i + FREQUENT_AT_ONCE] for i in range(0, len(frequent), FREQUENT_AT_ONCE)):
        i, a = np.arange(len(w)), before[w]
        r, l, s, n = right[w].astype(float), left[w].astype(float), own[w].astype(float)[:, None], size[w].astype(float)[:, None]
        r[i, a] -= s[:, 0]
        l[i, a] -= s[:, 0]
        rest = np.repeat(both[None], len(w), 0)  # the matrix without each word
        rest[i, a, :] -= r
        rest[i, :, a] -= l
        rest[i, a, a] -= s[:, 0]
        d, out_n, in_n, here = np.diagonal(rest, axis1=1, axis2=2), rest.sum(2), rest.sum(1), _f(rest)
        gain = (_f(rest + r[:, None, :]) - here).sum(2) + (_f(rest + l[:, :, None]) - here).sum(1)
        gain += _f(d + r + l + s) - _f(d + r) - _f(d + l) + _f(d)
        gain -= _f(out_n + n) - _f(out_n) + _f(in_n + n) - _f(in_n)
        gain[:, 0] = -np.inf
        b = np.argmax(gain, axis=1)
        of[w] = np.where(gain[i, b] <= gain[i, a] + 1e-9, a, b)
    rare = np.flatnonzero(~often)
    out_n, in_n = both.sum(1), both.sum(0)
    tables = []
    for sides in (both.T, both):  # [class beside the word, class of the word]
        few = np.arange(SMALL + 1)[:, None, None]
        tables.append((sides, _f(sides + few) - _f(sides), _f(sides) - _f(np.maximum(sides - few, 0))))
    step = max(1, CELLS_AT_ONCE // classes)
    for chunk in (rare[i : i + step] for i in range(0, len(rare), step)):
        a, n = of[chunk], size[chunk][:, None]
        gain = -(_f(out_n + n) - _f(out_n) + _f(in_n + n) - _f(in_n))
        n = n[:, 0]
        stay = -(_f(out_n[a]) - _f(out_n[a] - n) + _f(in_n[a]) - _f(in_n[a] - n))
        for side, (sides, more, less) in zip((right, left), tables, strict=True):
            w, c = np.nonzero(side[chunk])
            k = side[chunk][w, c]
            few = np.minimum(k, SMALL)
            join, leave = more[few, c], less[few, c, a[w]]
            big = np.flatnonzero(k > SMALL)
            if len(big):
                at, kb = sides[c[big]], k[big]
                join[big] = _f(at + kb[:, None]) - _f(at)
                at = sides[c[big], a[w[big]]]
                leave[big] = _f(at) - _f(at - kb)
            first = np.searchsorted(w, np.arange(len(chunk)))  # each word has a neighbour on either side
            gain += np.add.reduceat(join, first)
            stay += np.add.reduceat(leave, first)
        gain[:, 0] = -np.inf
        gain[np.arange(len(chunk)), a] = stay
        b = np.argmax(gain, axis=1)
        of[chunk] = np.where(gain[np.arange(len(chunk)), b] > stay + 1e-9, b, a)
    return of


def _counted(blocks: DataFrame, answers: DataFrame, totals: DataFrame, classes: int) -> DataFrame:
    """One row per part: for each of its words the classes beside it, and the class pairs that start with its words."""
    wide = 2 * classes + 1

    def count(left: pa.Table, found: pa.Table) -> pa.Table:
        out: dict[str, list] = {c.split()[0]: [] for c in CELLS.split(", ")}
        for block in left.to_pylist():
            rows, place = answered(block, found)
            if not rows:
                continue
            of = np.concatenate([unpack(r["classes"], 2) for r in rows])
            sizes = np.array(block["sizes"], np.int64)
            mine = np.array([in_training(d) for d in block["doc_ids"]], bool)
            words = place[unpack(block["codes"])[np.repeat(mine, sizes)]]
            sizes = sizes[mine]
            at = np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes) + 1
            line = np.full(len(words) + len(sizes) + 1, -1, np.int64)  # -1 is the end
            line[at] = words
            beside = np.where(line < 0, 0, of[line])
            keys = [words * wide + beside[at + 1], words * wide + classes + beside[at - 1]]
            keys.append(words[line[at + 1] == words] * wide + 2 * classes)
            keys, counts = np.unique(np.concatenate(keys), return_counts=True)
            starts = np.cumsum([0] + [len(unpack(r["classes"], 2)) for r in rows])
            cuts = np.searchsorted(keys, starts * wide)
            for r, first, i, j in zip(rows, starts, cuts, cuts[1:], strict=False):
                steps = np.diff(keys[i:j] - first * wide, prepend=0)
                new = (r["part"], r["block"], r["classes"], pack(steps, 8), pack(counts[i:j], 8))
                for k, v in zip(out, new, strict=True):
                    out[k].append(v)
        return pa.Table.from_pydict(out, schema=arrow(CELLS))

    def add(cells: pa.Table, own: pa.Table) -> pa.Table:
        places = {r["block"]: r for r in own.to_pylist()}
        known = next(iter(places.values()))["known"] if places else 0
        sums, of = np.zeros(known * wide, np.int64), np.zeros(known, np.uint16)
        for r in cells.to_pylist():
            place = unpack(places[r["block"]]["places"]).astype(np.int64)
            seen = place < known
            of[place[seen]] = unpack(r["classes"], 2)[seen]
            keys = np.cumsum(unpack(r["steps"], 8).astype(np.int64))
            sums[place[keys // wide] * wide + keys % wide] += unpack(r["counts"], 8).astype(np.int64)
        table = sums.reshape(known, wide)
        pairs = np.zeros((classes, classes), np.int64)
        np.add.at(pairs, of, table[:, :classes])
        pairs[0] += np.bincount(of, table[:, classes], classes).astype(np.int64)
        used = np.flatnonzero(sums)
        row = {
            "part": own.column("part")[:1], "classes": [pack(of, 2)], "steps": [pack(np.diff(used, prepend=0), 8)],
            "counts": [pack(sums[used], 8)], "pairs": [pairs.tobytes()],
            "distinct": [np.bincount(of, minlength=classes).astype(np.int64).tobytes()],
        }
        return pa.Table.from_pydict(row, schema=arrow(SUMS)) if known else arrow(SUMS).empty_table()

    cells = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(count, CELLS)
    own = totals.select("part", "block", "places", "known")
    return cells.groupBy("part").cogroup(own.groupBy("part")).applyInArrow(add, SUMS)


def _class_pairs(sums: DataFrame, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The class pairs of all parts, without pairs of two ends, and the number of distinct words in each class."""
    kind = "pairs binary, distinct binary"

    def add(batches):
        pairs, distinct = np.zeros(classes * classes, np.int64), np.zeros(classes, np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                pairs += np.frombuffer(r["pairs"], np.int64)
                distinct += np.frombuffer(r["distinct"], np.int64)
        yield pa.RecordBatch.from_pydict({"pairs": [pairs.tobytes()], "distinct": [distinct.tobytes()]}, schema=arrow(kind))

    pairs, distinct = np.zeros(classes * classes), np.zeros(classes)
    for r in sums.select("pairs", "distinct").mapInArrow(add, kind).toLocalIterator():
        pairs += np.frombuffer(r["pairs"], np.int64)
        distinct += np.frombuffer(r["distinct"], np.int64)
    return pairs.reshape(classes, classes), distinct


def _lots(marks: np.ndarray, turn: int) -> np.ndarray:
    """A number in [0, 1) for each word, from the word and the round."""
    seed = mixed(np.array([turn], np.uint64))
    return (mixed(marks ^ seed) >> np.uint64(11)) / 2.0**53


def _moved(totals: DataFrame, sums: DataFrame, both: np.ndarray, by_ending: np.ndarray, movers: float, turn: int) -> DataFrame:
    """The blocks' words with their classes after a round in which a share ``movers`` of the words may move."""
    classes = len(both)
    wide = 2 * classes + 1

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        of = np.zeros(0, np.int64)
        marks = np.frombuffer(b"".join(own.column("marks").drop_null().to_pylist()), np.uint64)  # of the part's first row
        for r in found.to_pylist():  # one row, or none
            of = unpack(r["classes"], 2).astype(np.int64)
            table = np.zeros(len(of) * wide, np.int64)
            table[np.cumsum(unpack(r["steps"], 8).astype(np.int64))] = unpack(r["counts"], 8)
            table = table.reshape(-1, wide)
            new = moves(both, table[:, :classes], table[:, classes:-1], table[:, -1], of)
            if movers < 1:
                new = np.where(_lots(marks, turn) < movers, new, of)
            of = new
        of = np.concatenate([of, by_ending])
        out: dict[str, list] = {c.split()[0]: [] for c in ANSWERS.split(", ")}
        for r in own.to_pylist():
            for k, v in zip(out, (r["part"], r["block"], r["fingerprint"], pack(of[unpack(r["places"])], 2)), strict=True):
                out[k].append(v)
        return pa.Table.from_pydict(out, schema=arrow(ANSWERS))

    own = totals.select("part", "block", "fingerprint", "places", "marks").groupBy("part")
    return own.cogroup(sums.select("part", "classes", "steps", "counts").groupBy("part")).applyInArrow(run, ANSWERS)


def cluster(blocks: DataFrame, totals: DataFrame, answers: DataFrame, by_ending: np.ndarray, classes: int, empty: float):
    """Rounds over all words: the blocks' words with their classes, the class pairs, the distinct words by class."""
    best, movers, turn = None, 1.0, 0
    while True:
        sums = stage(_counted(blocks, answers, totals, classes), "word-neighbours")
        both, distinct = _class_pairs(sums, classes)
        both[0, 0] += empty  # texts without words
        value = information(both)
        gain = None if best is None else value - best[0]
        if best is None or gain > 0:
            last, best = best, (value, answers, both, distinct, sums)
            if last is not None and gain <= GAIN * abs(last[0]):
                return best[1:4]
        elif movers <= LEAST_MOVERS or np.array_equal(both, best[2]):
            return best[1:4]
        else:
            movers /= 2
        turn += 1
        answers = stage(_moved(totals, best[4], best[2], by_ending, movers, turn), "word-classes")


class Model:
    """What scoring needs; its size depends on ``top`` and ``classes`` alone."""

    def __init__(self, pairs, of, top, distinct_by_item, tokens, distinct):
        self.top, self.of, self.tokens, self.distinct = top, of, tokens, distinct
        self.ends = int(pairs[:, 0].sum())
        classes = int(of.max()) + 1 if len(of) else 1
        one = np.zeros((len(of), classes))
        one[np.arange(len(of)), of] = 1
        both = one.T @ pairs @ one
        self.log_class = np.log10((both + CLASS_PRIOR) / (both.sum(1, keepdims=True) + CLASS_PRIOR * classes))
        self.class_total = both.sum(0) + WORD_PRIOR * (distinct_by_item @ one + 1)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def emission(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        return np.log10((counts + WORD_PRIOR) / self.class_total[classes])


def score(docs: DataFrame, top: int = TOP_WORDS, classes: int = CLASSES) -> DataFrame:
    """Per document: number of tokens, those known from training, the unigram score and the model's score."""
    spark = docs.sparkSession
    n = partitions(spark)
    docs = keyed(docs)
    parts = n * PARTS_PER_PARTITION
    train = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != HELD_OUT)

    totals = stage(_totals(requests(docs, parts, True, in_training), top), "word-totals")
    sums = totals.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    best = (
        totals.select(F.explode(F.arrays_zip("top", "top_counts")).alias("w"))
        .select("w.*").orderBy(F.desc("top_counts"), F.col("top").cast("binary")).limit(top).collect()
    )
    words = [r["top"].encode() for r in best]
    pairs = _pairs(train, words)
    ends = int(pairs[:, 0].sum())
    of = exchange(pairs, classes)
    width = int(of.max()) + 1

    def start(batches):
        item = Items(words)
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in ANSWERS.split(", ")}
            for r in batch.to_pylist():
                mine = unpack_words(r["words"])
                for k in ("part", "block", "fingerprint"):
                    out[k].append(r[k])
                out["classes"].append(pack(of[np.fromiter(map(item.__getitem__, mine), np.uint32, len(mine))], 2))
            yield pa.RecordBatch.from_pydict(out, schema=arrow(ANSWERS))

    answers = stage(totals.select("part", "block", "fingerprint", "words").mapInArrow(start, ANSWERS), "word-classes")
    blocks = numbered(docs, parts, True).repartition(n, "block").persist(StorageLevel.DISK_ONLY)
    by_ending = of[1 : 1 + ENDINGS]
    answers, both, distinct = cluster(blocks, totals, answers, by_ending, width, pairs[0, 0])
    model = Model(both, np.arange(width), [], distinct, sums[1] + ends, sums[0] + (ends > 0))

    def join(blocks: pa.Table, found: pa.Table) -> pa.Table:
        out: dict[str, list] = {c.split()[0]: [] for c in SCORES.split(", ")}
        end_base = float(model.base(np.array([model.ends]))[0])
        for block in blocks.to_pylist():
            rows, place = answered(block, found)
            counts = np.concatenate([unpack(r["totals"], 8) for r in rows]) if rows else np.zeros(0)
            of = np.concatenate([unpack(r["classes"], 2) for r in rows]) if rows else np.zeros(0, np.uint16)
            base, inside = model.base(counts), model.emission(counts, of)
            codes, at = place[unpack(block["codes"])], 0
            for doc_id, size in zip(block["doc_ids"], block["sizes"], strict=True):
                own = codes[at : at + size]
                at += size
                path = np.zeros(size + 2, np.int64)
                path[1:-1] = of[own]
                total = float(model.log_class[path[:-1], path[1:]].sum() + inside[own].sum())
                known = int((counts[own] > 0).sum()) + (model.ends > 0)
                held = None if doc_id is None else fold(doc_id) == HELD_OUT
                row = (doc_id, held, size + 1, known, model.tokens, float(base[own].sum()) + end_base, total)
                for k, v in zip(out, (*row, 10 ** min(300.0, -total / (size + 1))), strict=True):
                    out[k].append(v)
        return pa.Table.from_pydict(out, schema=arrow(SCORES))

    answers = answers.join(totals.select("part", "block", "totals"), ["part", "block"])
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, SCORES)
