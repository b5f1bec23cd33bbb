"""Order-preserving packing of documents into token windows by dynamic programming.

Documents are dealt into ranges of ``doc_id`` (ties by a hash of the text), and each range is one stream of tokens:
a document's ids, then the id that ends it. The stream is cut into windows of at most ``window`` tokens. A cut may
lie at the end of a document, at the end of a sentence, or, in a sentence longer than ``STRIDE`` tokens, at every
``STRIDE``-th token. The cuts chosen minimise the sum of the padding of all windows and a penalty for each cut inside
a document or a sentence:

    cost(j) = min over i with 0 < pos(j) - pos(i) <= window of
              cost(i) + window - (pos(j) - pos(i)) + penalty(j)

``cost(i) + pos(i)`` is all that depends on i, so the best i of the sliding range is the head of a monotone queue, and
a cut point costs constant time. Where a window would be as long as a power of two, it needs no padding; the tail of
a range is therefore left as one padded window or cut into powers of two, whichever costs less.

A task works through its range in stretches of about ``STRETCH`` bytes of text. The last window of
a stretch isn't closed but opens the next stretch, so only the tail of a range is padded for want of text.

A null text is empty: its document is its end alone. Repeated rows are packed one by one. Null ids come first.
An empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.bpe import WordEncoder, joined, vocabulary_path
from tradeloom.llm.common import keyed
from tradeloom.llm.wordblocks import arrow, texts_of

WINDOW = 2048
END = 1
#: Padding tokens that a cut inside a document, or inside a sentence, is worth avoiding.
IN_DOCUMENT, IN_SENTENCE = 2, 12
STRIDE = 32
STRETCH = 10 << 20
WORDS_AT_ONCE = 1 << 17
#: Words whose ids a Python worker holds from one range to the next; beyond that it starts over.
KEPT_WORDS = 2_000_000
#: Bytes of text for a range; fewer ranges mean fewer tails.
RANGE_BYTES = 32 << 20

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, ids array<int>"
)

# After a word that ends a sentence, and any closing quotes or brackets.
_LAST = frozenset(b".!?\"')]")
_SENTENCE = re.compile(rb"[.!?]+[\"')\]]*\Z")


def windows(at: np.ndarray, penalty: np.ndarray, window: int) -> list[int]:
    """The cuts of least cost: indices into ``at``, whose first element is where the stream begins and whose last
    is where it ends. Neighbours in ``at`` are at most ``window`` apart."""
    places, penalties = at.tolist(), penalty.tolist()
    cost, back = [0] * len(places), [0] * len(places)
    queue: deque[tuple[int, int]] = deque([(places[0], 0)])  # cost(i) + pos(i), rising
    for j in range(1, len(places)):
        here = places[j]
        while here - places[queue[0][1]] > window:
            queue.popleft()
        best, i = queue[0]
        back[j] = i
        cost[j] = best + window - here + penalties[j]
        value = cost[j] + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(places) - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def tail(n: int, window: int) -> list[int]:
    """Lengths for the last ``n`` tokens: whole, or as powers of two, whose cuts are penalised."""
    powers = [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]
    return powers if (len(powers) - 1) * IN_SENTENCE < window - n else [n]


class _Table:
    """Strings by number, with the ids of each; as Arrow and numpy arrays, so that millions take little memory."""

    def __init__(self):
        self.known = pa.array([], pa.large_string())
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def numbers(self, strings: pa.Array, ids_of) -> np.ndarray:
        """The number of each of some distinct strings; ``ids_of`` gives the number of ids and the ids of new ones."""
        found = pc.index_in(strings, value_set=self.known)
        is_new = found.is_null()
        fresh = strings.filter(is_new)
        out = found.fill_null(0).to_numpy().astype(np.int64)
        if len(fresh):
            lengths, ids = ids_of(fresh)
            out[is_new.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(fresh))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths, self.ids = np.concatenate([self.lengths, lengths]), np.concatenate([self.ids, ids])
            self.known = pa.concat_arrays([self.known, fresh])
        return out

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each, and all their ids in a row."""
        lengths = self.lengths[numbers]
        out, done = np.empty(int(lengths.sum()), np.uint32), 0
        for a in range(0, len(numbers), WORDS_AT_ONCE):  # what is worked out on the way is several times the ids
            own, n = numbers[a : a + WORDS_AT_ONCE], lengths[a : a + WORDS_AT_ONCE]
            ends = np.cumsum(n)
            out[done : done + ends[-1]] = self.ids[np.repeat(self.starts[own] - (ends - n), n) + np.arange(ends[-1])]
            done += int(ends[-1])
        return lengths, out


def _bytes(strings: pa.Array) -> list[bytes]:
    return strings.cast(pa.large_binary()).to_pylist()


class _Words:
    """The ids of words. A word is mostly a run of letters, which words with other marks share, and marks after it."""

    def __init__(self, encoder: WordEncoder):
        self.encoder = encoder
        self.words = _Table()
        self.stops = np.zeros(0, bool)  # of the words: do they end a sentence?

    def numbers(self, distinct: pa.Array) -> np.ndarray:
        """The number of each of some distinct words; an earlier answer holds until ``KEPT_WORDS`` are known."""
        if len(self.words.known) > KEPT_WORDS:
            self.words, self.stops = _Table(), np.zeros(0, bool)
        return self.words.numbers(distinct, self._learn)

    def _learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw = _bytes(words)
        ends = [w[-1] in _LAST and _SENTENCE.search(w) is not None for w in raw]
        self.stops = np.concatenate([self.stops, np.array(ends, bool)])
        bare = pc.ascii_rtrim(words, characters=self.encoder.MARKS.decode())
        coded = pc.ascii_lower(bare).dictionary_encode()
        known, own = self.encoder.parts, []
        for x in _bytes(coded.dictionary):
            own.append((known[x] if x in known else self.encoder.part(x)) if x else None)
            known = self.encoder.parts  # which starts over when it has grown too large
        part, part_ids = joined([x or b"" for x in own])
        of = coded.indices.to_numpy()
        lengths, at = part[of], (np.cumsum(part) - part)[of]
        is_part = lengths > 0
        # marks after letters; whatever isn't letters and marks goes through the whole tokenizer
        marks = (pc.binary_length(words).to_numpy() - pc.binary_length(bare).to_numpy()) * is_part
        kinds: dict[bytes, int] = {b"": 0}
        tail = np.zeros(len(raw), np.int64)
        for i in np.flatnonzero(marks).tolist():
            tail[i] = kinds.setdefault(raw[i][-marks[i] :], len(kinds))
        others = np.flatnonzero(~is_part).tolist()
        rest = self.encoder.encode([raw[i] for i in others])
        end = np.zeros(len(raw), np.int64)
        end[others] = np.arange(len(kinds), len(kinds) + len(others))
        after = np.where(is_part, tail, end)
        more, more_ids = joined([self.encoder.tail(t) if t else b"" for t in kinds] + rest)
        total = lengths + more[after]
        ids = np.empty(int(total.sum()), np.uint32)
        place = np.cumsum(total) - total
        _copy(ids, place, part_ids, at, lengths)
        _copy(ids, place + lengths, more_ids, (np.cumsum(more) - more)[after], more[after])
        return total, ids


def _copy(to: np.ndarray, place: np.ndarray, ids: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> None:
    """Runs of ids from ``at`` on to ``place``."""
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    to[np.repeat(place, lengths) + within] = ids[np.repeat(at, lengths) + within]


_known: dict[str, _Words] = {}


def words_of_worker(path: str) -> _Words:
    """The words that this Python worker knows: the tokenizer is loaded, and a word encoded, once for all its ranges."""
    if path not in _known:
        _known.clear()
        _known[path] = _Words(WordEncoder(path))
    return _known[path]


def split(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, the words of all of them as numbers of those, and how many each text has."""
    cut = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    words, of = cut.flatten(), pc.list_parent_indices(cut).to_numpy()
    real = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
    coded = words.filter(real).dictionary_encode()
    counts = np.bincount(of[real.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return coded.dictionary, coded.indices.to_numpy(), counts


class _Stream:
    """The tokens of a range that aren't packed yet."""

    def __init__(self, first: int, window: int, path: str):
        self.sequence, self.window, self.path = first, window, path
        self.docs: list[list] = []  # doc_id, tokens of the document, tokens of it that are packed
        self.ids = np.zeros(0, np.uint32)
        self.at, self.penalty = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, doc_ids: list[int | None], texts: list[bytes]) -> None:
        """Append documents: their ids, and where they may be cut at what penalty."""
        words = words_of_worker(self.path)
        distinct, codes, counts = split(texts)
        numbers = words.numbers(distinct)[codes]
        own, flat = words.words.gathered(numbers)
        # the end of a document is a word of one id after its last
        last = np.cumsum(counts + 1) - 1
        before = np.cumsum(counts)
        lengths, stops = np.insert(own, before, 1), np.insert(words.stops[numbers], before, False)
        ends = np.cumsum(lengths)  # of the words, in tokens
        ids = np.empty(int(ends[-1]), np.uint32)
        is_end = np.zeros(len(ids), bool)
        is_end[ends[last] - 1] = True
        ids[is_end], ids[~is_end] = END, flat
        stops[last[last > 0] - 1] = False  # the end of a document stays with its last sentence
        soft = np.flatnonzero(stops)
        cut = np.unique(np.concatenate([soft, last]))
        at = ends[cut]
        at, first = np.unique(at, return_index=True)
        worth = np.where(np.isin(cut[first], last), 0, IN_DOCUMENT)
        # within long sentences, every STRIDE tokens
        starts = np.concatenate([[0], at[:-1]])
        more = (at - starts - 1) // STRIDE
        fine = np.repeat(starts - (np.cumsum(more) - more) * STRIDE, more) + (np.arange(more.sum()) + 1) * STRIDE
        at, worth = np.concatenate([at, fine]), np.concatenate([worth, np.full(len(fine), IN_SENTENCE)])
        order = np.argsort(at, kind="stable")
        self.at = np.concatenate([self.at, at[order] + len(self.ids)])
        self.penalty = np.concatenate([self.penalty, worth[order]])
        self.ids = np.concatenate([self.ids, ids])
        tokens = np.diff(np.concatenate([[0], ends[last]])).tolist()
        self.docs += [[d, n, 0] for d, n in zip(doc_ids, tokens, strict=True)]

    def pack(self, last: bool) -> Iterator[tuple]:
        """Pieces of the windows that can be closed; all of them, if this is the end of the range."""
        size = len(self.ids)
        if not size:
            return
        at, penalty = np.concatenate([[0], self.at]), np.concatenate([[0], self.penalty])
        ends = at[windows(at, penalty, self.window)].tolist()
        begin = ends[-2] if len(ends) > 1 else 0
        lengths = np.diff([0, *ends[:-1]]).tolist() + (tail(size - begin, self.window) if last else [])
        done, doc = 0, 0
        for length in lengths:
            offset = 0
            while offset < length:
                own = self.docs[doc]
                doc_id, n, packed = own
                take = min(n - packed, length - offset)
                yield doc_id, packed, take, self.ids[done : done + take], n, self.sequence, offset
                own[2] += take
                doc += own[2] == n
                done += take
                offset += take
            self.sequence += 1
        self.docs, self.ids = self.docs[doc:], self.ids[done:]
        keep = self.at > done
        self.at, self.penalty = self.at[keep] - done, self.penalty[keep]


def stretches(doc_ids: Iterable, texts: Iterable[bytes]) -> Iterator[tuple[list, list[bytes]]]:
    """Documents in runs of about ``STRETCH`` bytes."""
    ids, run, size = [], [], 0
    for doc_id, text in zip(doc_ids, texts, strict=True):
        ids.append(doc_id)
        run.append(text)
        size += len(text)
        if size >= STRETCH:
            yield ids, run
            ids, run, size = [], [], 0
    if ids:
        yield ids, run


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None, digest_only: bool = False) -> DataFrame:
    """One row per piece: the part of a document that lies in one sequence, where, and its ids.

    ``digest_only`` leaves the ids themselves out; their CRC-32 stays.
    """
    path = path or vocabulary_path()
    names = [c.split()[0] for c in PIECES.split(", ")]
    rows = keyed(docs)
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    ranges = max(1, -(-size // RANGE_BYTES))

    def run(batches):
        stream = _Stream(TaskContext.get().partitionId() << 40, window, path)

        def rows_of(pieces) -> pa.RecordBatch:
            out: dict[str, list] = {k: [] for k in names}
            for doc_id, start, length, own, n, sequence, offset in pieces:
                crc = zlib.crc32(own.astype("<u4").tobytes())
                row = (doc_id, start, length, crc, n, sequence, offset, own[:0] if digest_only else own.astype(np.int32))
                for k, v in zip(names, row, strict=True):
                    out[k].append(v)
            flat = np.concatenate([np.zeros(0, np.int32), *out["ids"]])
            ends = np.cumsum([0, *map(len, out["ids"])]).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(ends, pa.array(flat.astype(np.int32)))
            return pa.RecordBatch.from_pydict(out, schema=arrow(PIECES))

        for batch in batches:
            for doc_ids, texts in stretches(batch.column("doc_id").to_pylist(), texts_of(batch)):
                stream.add(doc_ids, texts)
                yield rows_of(stream.pack(False))
        yield rows_of(stream.pack(True))

    dealt = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange(ranges, "doc_id", "_tie")
    ordered = dealt.sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    packed = ordered.mapInArrow(run, PIECES)
    return packed.drop("ids") if digest_only else packed
