"""BPE encoding and decoding through a table of distinct words.

Texts are split at ASCII white space, where the tokenizer always cuts, so that a text's ids are its words' ids in
order. Each distinct word is encoded once, in the one partition where all requests for it meet
(`wordblocks`), and its ids return to every position of the word. Decoding looks each id's piece up in the
vocabulary and joins the pieces with blanks, as the library does for a tokenizer without a decoder.

The tokenizer must cut at white space and drop it (as ``word_bpe_49k.json`` does), which is tested against whole
texts. A null text counts as empty: no ids, an empty decoded text. Repeated rows and ids give a row each; a null
``doc_id`` stays null; other columns are not looked at. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradeloom.llm.common import keyed, partitions
from tradeloom.llm.wordblocks import (
    PARTS_PER_PARTITION,
    answered,
    arrow,
    numbered,
    pack,
    requests,
    unpack,
    unpack_words,
)

ANSWERS = "part int, block bigint, fingerprint bigint, lengths binary, ids binary"
ENCODED = "doc_id bigint, ids array<int>, text string"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
#: A worker keeps the ids of at most so many words of its partition at hand; beyond that it starts over.
KEPT_WORDS = 400_000


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def pieces_of(tokenizer) -> list[str]:
    """The id-to-piece table; its size is the vocabulary's."""
    table = [""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for piece, i in tokenizer.get_vocab(with_added_tokens=True).items():
        table[i] = piece
    return table


class WordEncoder:
    """Encodes words. Most are Latin letters, then perhaps marks that end a clause: the tokenizer cuts such a word
    between the two and changes nothing but case, so its model can be asked for the parts, which many words
    share. All others go through the whole tokenizer, many at a time, with a special token in between.

    Ids are held as the bytes of little-endian unsigned 32-bit numbers, a fifth of what lists of numbers take."""

    MARKS = b".,;:!?"
    LETTERS = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    BETWEEN = "<|endoftext|>"
    AT_ONCE = 200

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.stop = self.tokenizer.token_to_id(self.BETWEEN)
        # bytes without a visible character of their own stand in the vocabulary as characters from 256 on
        visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.shown = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in visible)}
        self.parts: dict[bytes, bytes | None] = {}
        self.tails: dict[bytes, bytes] = {}

    def part(self, raw: bytes) -> bytes | None:
        """The ids of a run of Latin letters; None for anything else."""
        if len(self.parts) > KEPT_WORDS:
            self.parts = {}
        if raw.isalpha():  # ASCII letters only
            small = raw.lower()
            if small in self.parts:  # under another case
                self.parts[raw] = found = self.parts[small]
                return found
            shown = small.decode()
        else:
            text = raw.decode()
            if not self.LETTERS.fullmatch(text):
                self.parts[raw] = None
                return None
            shown = text.lower().encode().decode("latin-1").translate(self.shown)
        self.parts[raw] = found = _raw([t.id for t in self.model.tokenize(shown)])
        return found

    def tail(self, raw: bytes) -> bytes:
        if len(self.tails) > KEPT_WORDS:
            self.tails = {}
        self.tails[raw] = found = _raw([t.id for t in self.model.tokenize(raw.decode())])
        return found

    def encode(self, words: list[bytes]) -> list[bytes]:
        out, others = [], []
        for word in words:
            bare = word.rstrip(self.MARKS)
            if bare:
                ids = self.parts[bare] if bare in self.parts else self.part(bare)
                if ids is None:
                    others.append(len(out))
                elif len(bare) < len(word):
                    tail = word[len(bare) :]
                    ids = ids + (self.tails[tail] if tail in self.tails else self.tail(tail))
                out.append(ids)
            else:
                out.append(self.tail(word))
        if self.stop is None:
            alone, others = others, []
        else:
            alone = [i for i in others if b"<|" in words[i]]
            others = [i for i in others if b"<|" not in words[i]]
        for i in alone:
            out[i] = _raw(self.tokenizer.encode(words[i].decode(), add_special_tokens=False).ids)
        for a in range(0, len(others), self.AT_ONCE):
            some = others[a : a + self.AT_ONCE]
            text = self.BETWEEN.join([words[i].decode() for i in some])
            ids, at = self.tokenizer.encode(text, add_special_tokens=False).ids, 0
            ids.append(self.stop)
            for i in some:
                end = ids.index(self.stop, at)
                out[i] = _raw(ids[at:end])
                at = end + 1
        return out


def _raw(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The number of ids of each word, and all their ids in a row."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) // 4
    return lengths, np.frombuffer(b"".join(words), "<u4")


def _answers(asked: DataFrame, path: str, n: int) -> DataFrame:
    """Encode the words of each part; a word is in one part only."""

    def run(batches):
        encoder, known = WordEncoder(path), {}
        for batch in batches:
            for r in batch.to_pylist():
                words = unpack_words(r["words"])
                if len(known) + len(words) > KEPT_WORDS:
                    known = {}
                new = [w for w in words if w not in known]
                known.update(zip(new, encoder.encode(new), strict=True))
                found = [known[w] for w in words]
                row = {k: [r[k]] for k in ("part", "block", "fingerprint")}
                lengths, ids = joined(found)
                row |= {"lengths": [pack(lengths)], "ids": [pack(ids)]}
                yield pa.RecordBatch.from_pydict(row, schema=arrow(ANSWERS))

    return asked.drop("counts").repartition(n, "part").mapInArrow(run, ANSWERS)


def _encode(docs: DataFrame, path: str, schema: str, row_of) -> DataFrame:
    """``row_of(doc_id, ids, text)`` for every document, with the ids as an array and the decoded text."""
    n = partitions(docs.sparkSession)
    docs = keyed(docs)
    parts = n * PARTS_PER_PARTITION
    answers = _answers(requests(docs, parts), path, n)
    names = [c.split()[0] for c in schema.split(", ")]

    def join(blocks: pa.Table, found: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in names}
        pieces = pieces_of(load(path))
        for block in blocks.to_pylist():
            rows, place = answered(block, found)
            lengths = np.concatenate([unpack(r["lengths"]) for r in rows]) if rows else np.zeros(0, np.uint32)
            flat = np.concatenate([unpack(r["ids"]) for r in rows]) if rows else np.zeros(0, np.uint32)
            ends = np.cumsum(lengths, dtype=np.int64)
            flat_pieces = [pieces[i] for i in flat.tolist()]
            cuts = [0, *ends.tolist()]
            text_of = [" ".join(flat_pieces[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            del flat_pieces
            codes, at = place[unpack(block["codes"])], 0
            for doc_id, size in zip(block["doc_ids"], block["sizes"], strict=True):
                own = codes[at : at + size]
                at += size
                long = lengths[own].astype(np.int64)
                # the ids of word after word: the start of each word's ids, repeated, plus a running count
                first = np.repeat(ends[own] - long - np.concatenate([[0], np.cumsum(long)[:-1]]) if size else long, long)
                ids = flat[first + np.arange(len(first))]
                text = " ".join([t for t in map(text_of.__getitem__, own.tolist()) if t])
                for k, v in zip(names, row_of(doc_id, ids, text), strict=True):
                    out[k].append(v)
        return pa.Table.from_pydict(out, schema=arrow(schema))

    blocks = numbered(docs, parts).groupBy("block")
    return blocks.cogroup(answers.groupBy("block")).applyInArrow(join, schema)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, and the text decoded from them."""
    return _encode(docs, path or vocabulary_path(), ENCODED, lambda d, ids, text: (d, ids.astype(np.int32), text))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, number of ids, SHA-256 of the ids as little-endian unsigned 32-bit numbers and of the decoded text."""

    def row_of(doc_id, ids, text):
        raw = ids.astype("<u4").tobytes()
        return doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    return _encode(docs, path or vocabulary_path(), DIGESTS, row_of)
