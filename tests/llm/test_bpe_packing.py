import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import TEXT, documents, ordered, pairs, texts

from tradeloom.llm import bpe, packing

ODD = [
    (1, ""), (2, None), (3, "a\x0bb c\x0cd"), (4, "<|endoftext|>x <|startoftext|> y"), (5, "don't 's 12 ﬁ É é x y"),
    (6, "ΑΣ ας Σ"), (7, "́ ́a a ́"), (8, "x" * 5000), (9, " \n\t "), (10, "\x1cab\x1d c\x85d"),
    (11, "İstanbul ẞ"), (None, "no id"), (12, "same. row"), (12, "same. row"), (13, "long " * 3000),
]


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.load(bpe.vocabulary_path())


def encoded(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_ids_and_texts_are_the_librarys(spark, tokenizer):
    for frame in (texts(spark, ODD), documents(spark)):
        got = [(r.doc_id, r.text, list(r.ids)) for r in bpe.encode(frame).collect()]
        want = [(d, (e := encoded(tokenizer, t))[1], e[0]) for d, t in pairs(frame)]
        assert ordered(got) == ordered(want)


def test_digests(spark, tokenizer):
    got = [tuple(r) for r in bpe.digests(texts(spark, ODD)).collect()]
    want = []
    for d, t in ODD:
        ids, text = encoded(tokenizer, t)
        raw = np.array(ids, "<u4").tobytes()
        want.append((d, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert ordered(got) == ordered(want)


def test_words_are_encoded_as_the_tokenizer_does(tokenizer):
    rng = random.Random(1)
    alphabet = "aZéÉßÿÀªºµ'.,!?;:-<|>9ñ’́ſK"
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9))).encode() for _ in range(5000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in bpe.WordEncoder(bpe.vocabulary_path()).encode(words)]
    assert got == [c.ids for c in tokenizer.encode_batch([w.decode() for w in words], add_special_tokens=False)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], TEXT)
    assert bpe.encode(empty).count() == bpe.digests(empty).count() == packing.pack(empty).count() == 0


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_pieces_put_together_are_the_documents(spark, tokenizer, source):
    frame = texts(spark, ODD) if source == "odd" else documents(spark)
    rows = [r.asDict() for r in packing.pack(frame).collect()]
    # sequences are gapless and short enough
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    lengths = []
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in own]).tolist()
        assert [r["offset"] for r in own] == [0, *ends[:-1]]
        assert ends[-1] <= packing.WINDOW
        lengths.append(ends[-1])
    # each document's pieces make up its ids
    found = []
    rows.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        if r["start"] == 0:
            found.append((r["doc_id"], []))
        assert found[-1][0] == r["doc_id"] and len(found[-1][1]) == r["start"]
        found[-1][1].extend(r["ids"])
        if r["start"] + r["length"] == r["doc_tokens"]:
            assert len(found[-1][1]) == r["doc_tokens"]
    want = [(d, encoded(tokenizer, t)[0] + [1]) for d, t in pairs(frame)]
    assert ordered(found) == ordered(want)
    padding = sum(packing.WINDOW - n for n in lengths if n & (n - 1))
    if source == "documents":
        assert padding <= 0.03 * sum(lengths)


def test_cuts_are_the_best():
    """Against trying all ways to cut."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        gaps = rng.integers(1, 7, size=9)
        at = np.concatenate([[0], np.cumsum(gaps)])
        penalty = np.concatenate([[0], rng.integers(0, 6, size=9)])
        window = 10

        def cost(cuts):
            ends = [0, *cuts]
            if any(at[b] - at[a] > window for a, b in zip(ends, ends[1:], strict=False)):
                return np.inf
            return sum(window - (at[b] - at[a]) + penalty[b] for a, b in zip(ends, ends[1:], strict=False))

        ways = ([j for j in range(1, 9) if m >> (j - 1) & 1] + [9] for m in range(1 << 8))
        best = min(map(cost, ways))
        assert cost(packing.windows(at, penalty, window)) == best


def test_tail_is_padded_or_cut_into_powers_of_two():
    for n in (1, 5, 64, 1000, 1984, 2040, 2047, 2048):
        parts = packing.tail(n, 2048)
        assert sum(parts) == n
        assert parts == [n] or all(p & (p - 1) == 0 for p in parts)
    assert packing.tail(2040, 2048) == [2040] and packing.tail(1024, 2048) == [1024]
