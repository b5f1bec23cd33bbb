"""License notices in texts: an exact set-similarity join of text blocks with templates.

A word is a run of digits, a-z (A-Z are lower-cased) and characters above ASCII. Each template is the set of its words. Its class
is the least power of two that its words fit into, 8 at least; a text is cut into blocks of twice that many words, a class apart,
so that any run of words as long as the template lies whole in a block. A block matches if it holds at least ``SHARE`` of the
template's set (containment), and all such pairs are found:

* one pass over the texts counts the words of the templates over all documents, and keeps of each block those of its words that
  are in some template. Blocks with too few of them to match the smallest template of their class can't match (length filter);
* both sides are put into the order of those counts, rarest first. If a block holds ``o`` of a template's ``m`` words, the first
  that they share is among the first m - o + 1 of the template and among the first b - o + 1 of the block's b words: the two
  sides are joined on the words of these prefixes (prefix filter), and a pair stays only if enough words are left on both sides
  from there on (positional filter);
* what is left is verified on the full sets.

Of templates of one family found in one block, those with the most words found there stay (so that a notice for version 2 is not
one for version 3 as well). The base scan finds phrases, word after word; its labels stay whatever the method finds. ``score`` is
the greatest containment among the templates that stay, 1 if a phrase was found, else 0.

A null text is an empty one: no words, no labels, score 0. Rows are judged one by one, so repeated rows and ids, and null ids,
are kept as they are. The templates are a parameter of bounded size (``MOST_WORDS``); they and their words' counts are all that the
driver and the tasks hold beside a slice of texts. A text of any length is read in segments; of its words the numbers are held.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import keyed, stage
from tradeloom.llm.license_texts import NOTICES, PHRASES

#: Containment, in hundredths.
SHARE = 85
#: Most words of all templates and phrases together: what tasks and driver hold grows with them.
MOST_WORDS = 10_000
SMALLEST = 8
SEGMENT, SLICE = 1 << 20, 1 << 22

#: Bytes of words to themselves, A-Z to a-z, all others to a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_DOC, _COUNTS, _BLOCK = 0, 1, 2
_SCHEMA = (
    "kind int, row bigint, doc_id bigint, n_words bigint, places array<struct<label:string,n:bigint,first:bigint,last:bigint>>,"
    " class int, block bigint, tokens array<int>, counts array<bigint>"
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Template:
    def __init__(self, label: str, text: str):
        found = words(text.encode())
        self.label, self.family, self.words = label, label.split("-")[0], set(found)
        self.size = len(self.words)
        self.needed = -(-self.size * SHARE // 100)
        self.kind = max(SMALLEST, 1 << (len(found) - 1).bit_length())


class Templates:
    def __init__(self, notices: Sequence[tuple[str, str]] = NOTICES, phrases: dict[str, str] = PHRASES):
        self.all = [Template(*n) for n in notices]
        own = {w for t in self.all for w in t.words} | {w for p in phrases for w in words(p.encode())}
        if len(own) > MOST_WORDS or not all(t.size for t in self.all):
            raise ValueError(f"templates must have words, and no more than {MOST_WORDS}")
        self.vocabulary = sorted(own)
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.number = number
        self.phrases = [(label, [number[w] for w in words(p.encode())]) for p, label in phrases.items()]
        #: class -> the fewest words of a template's set that make a match
        self.least = {k: min(t.needed for t in self.all if t.kind == k) for k in {t.kind for t in self.all}}

    def scan(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From (row, doc_id, text) to a row for each document, one for each block that may match, and one with the counts."""
        counts = np.zeros(len(self.vocabulary), np.int64)
        for batch in batches:
            for rows, ids, texts in _slices(batch):
                known = self.number.get
                cut = [_numbers(t, known) for t in texts]
                sizes = np.fromiter(map(len, cut), np.int64, len(cut))
                # all texts in a row, a -2 after each
                flat = np.concatenate([x for c in cut for x in (c, _END)])
                starts = np.cumsum(sizes + 1) - sizes - 1
                hits = np.flatnonzero(flat >= 0)
                counts += np.bincount(flat[hits], minlength=len(counts))
                yield self._documents(rows, ids, sizes, flat, starts)
                docs = np.searchsorted(starts, hits, "right") - 1
                for kind, least in self.least.items():
                    if found := _blocks(kind, least, docs, hits - starts[docs], flat[hits], sizes, len(counts)):
                        which, block, tokens = found
                        yield _batch(len(which), kind=np.full(len(which), _BLOCK), row=rows[which], block=block, tokens=tokens, **{"class": np.full(len(which), kind)})
        at = np.flatnonzero(counts)
        yield _batch(1, kind=[_COUNTS], tokens=[at.tolist()], counts=[counts[at].tolist()])

    def _documents(self, rows, ids, sizes, flat, starts) -> pa.RecordBatch:
        places: list[list[dict]] = [[] for _ in rows]
        for label, phrase in self.phrases:
            at = np.flatnonzero(flat[: len(flat) - len(phrase) + 1] == phrase[0])
            for k, w in enumerate(phrase[1:], 1):
                at = at[flat[at + k] == w]
            docs = np.searchsorted(starts, at, "right") - 1
            for d, first, n in zip(*np.unique(docs, return_index=True, return_counts=True), strict=True):
                own = at[first : first + n] - starts[d]
                places[d].append({"label": label, "n": int(n), "first": int(own[0]), "last": int(own[-1])})
        return _batch(len(rows), kind=np.full(len(rows), _DOC), row=rows, doc_id=ids, n_words=sizes, places=places)

    def ranks(self, counts: DataFrame) -> list[int]:
        """The place of each word of the vocabulary in the global order, rarest first, ties by the word."""
        found = dict(counts.select(F.explode(F.arrays_zip("tokens", "counts")).alias("x")).groupBy("x.tokens").agg(F.sum("x.counts")).collect())
        order = sorted(range(len(self.vocabulary)), key=lambda i: (found.get(i, 0), i))
        return [r for _, r in sorted(zip(order, range(len(order)), strict=True))]


_END = np.array([-2], np.int32)


def _slices(batch: pa.RecordBatch):
    """Rows of a batch, by some megabytes of text."""
    rows, ids = batch.column("row").to_numpy(), batch.column("doc_id")
    texts = pc.cast(batch.column("text"), pa.large_binary())
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield rows[a:b], ids.slice(a, b - a), (t.as_py() for t in texts.slice(a, b - a))


def _numbers(text: bytes | None, known) -> np.ndarray:
    """For each word its number in the vocabulary, or -1; the words themselves are held a segment at a time."""
    text = (text or b"").translate(_TABLE)
    found, at = [], 0
    while at < len(text):
        end = text.find(b" ", at + SEGMENT)
        end = len(text) if end < 0 else end
        found.append(np.array([known(w, -1) for w in text[at:end].split()], np.int32))
        at = end
    return np.concatenate(found) if found else _END[:0]


def _blocks(kind: int, least: int, docs, at, tokens, sizes, width: int):
    """(document, block, tokens) of the blocks with at least ``least`` of the vocabulary's words, from the place of each in its text."""
    half = at // kind
    # half blocks are numbered through all texts, with one unused before each text
    first = np.concatenate([[0], np.cumsum(sizes // kind + 2)])
    slot = first[docs] + half + 1
    count = np.bincount(slot, minlength=first[-1] + 1)
    full = count[:-1] + count[1:] >= least  # block b: half blocks b and b + 1, repeated words not yet taken out
    pairs = []
    for back in (0, 1):
        block = slot - back
        keep = full[block] & (half >= back)
        pairs.append(block[keep] * width + tokens[keep])
    pairs = np.unique(np.concatenate(pairs))
    block, tokens = pairs // width, pairs % width
    own, at, n = np.unique(block, return_index=True, return_counts=True)
    keep = n >= least
    own, at, n = own[keep], at[keep], n[keep]
    if not len(own):
        return None
    which = np.searchsorted(first, own, "right") - 1
    return which, own - first[which] - 1, [tokens[a : a + k].tolist() for a, k in zip(at, n, strict=True)]


def _batch(n: int, **columns) -> pa.RecordBatch:
    place = pa.list_(pa.struct([("label", pa.string()), ("n", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))
    types = {
        "kind": pa.int32(), "row": pa.int64(), "doc_id": pa.int64(), "n_words": pa.int64(), "places": place,
        "class": pa.int32(), "block": pa.int64(), "tokens": pa.list_(pa.int32()), "counts": pa.list_(pa.int64()),
    }
    made = [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays(made, names=list(types))


def scanned(docs: DataFrame, templates: Templates) -> DataFrame:
    """One pass over the texts, written: documents, blocks and counts by ``kind``."""
    rows = keyed(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return stage(rows.mapInArrow(templates.scan, _SCHEMA), "license-scan")


def matches(scan: DataFrame, templates: Templates) -> DataFrame:
    """Every pair of a block and a template that it holds enough of.

    row, class, block, template (its number), label, family, overlap, containment, and start, the block's first word.
    """
    spark = scan.sparkSession
    ranks = templates.ranks(scan.filter(F.col("kind") == _COUNTS))
    prefixes, sets = [], []
    for no, t in enumerate(templates.all):
        own = sorted(ranks[templates.number[w]] for w in t.words)
        sets.append((no, t.label, t.family, t.size, t.needed, own))
        prefixes += [(t.kind, r, no, t.size - i, t.needed) for i, r in enumerate(own[: t.size - t.needed + 1])]
    # at most MOST_WORDS prefix rows and as many words in the sets: small enough to be sent to every task
    prefixes = F.broadcast(spark.createDataFrame(prefixes, "class int, rank int, template int, left int, needed int"))
    sets = F.broadcast(spark.createDataFrame(sets, "template int, label string, family string, size int, needed int, own array<int>"))
    least = F.create_map(*[F.lit(x) for k, v in templates.least.items() for x in (k, v)])
    by_rank = F.array_sort(F.transform("tokens", lambda t: F.get(F.array(*map(F.lit, ranks)), t)))
    blocks = scan.filter(F.col("kind") == _BLOCK).select("row", "class", "block", by_rank.alias("ranks"))
    prefix = F.slice("ranks", 1, F.size("ranks") - least[F.col("class")] + 1)
    probes = blocks.select("*", F.posexplode(prefix).alias("j", "rank")).join(prefixes, ["class", "rank"])
    probes = probes.filter((F.col("left") >= F.col("needed")) & (F.size("ranks") - F.col("j") >= F.col("needed")))
    pairs = probes.groupBy("row", "class", "block", "template").agg(F.first("ranks").alias("ranks"))
    found = pairs.join(sets, "template").withColumn("overlap", F.size(F.array_intersect("ranks", "own")))
    return found.filter("overlap >= needed").select(
        "row", "class", "block", "template", "label", "family", "overlap",
        (F.col("overlap") / F.col("size")).alias("containment"), (F.col("block") * F.col("class")).alias("start"),
    )


def _best(found: DataFrame) -> DataFrame:
    """Of the templates of one family in one block, those with most words found."""
    one = F.struct("overlap", "label", "containment")
    of_family = found.groupBy("row", "class", "block", "family").agg(F.max("overlap").alias("most"), F.collect_list(one).alias("all"))
    return of_family.select("row", F.explode(F.filter("all", lambda x: x["overlap"] == F.col("most"))).alias("x")).select("row", "x.*")


def judged(docs: DataFrame, templates: Templates | None = None) -> DataFrame:
    """Per document: the base places, its labels and the score."""
    templates = templates or Templates()
    scan = scanned(docs, templates)
    best = _best(matches(scan, templates)).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    rows = scan.filter(F.col("kind") == _DOC).join(best, "row", "left")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(labels), ",")

    base = F.transform("places", lambda p: p["label"])
    return rows.select(
        "doc_id", "n_words",
        F.aggregate("places", F.lit(0).cast("bigint"), lambda n, p: n + p["n"]).alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["last"])).alias("last_word"),
        listed(F.array_distinct(base)).alias("base_labels"),
        listed(F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
