import glob
import hashlib
import io
import math
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from helpers import SF_DIR, TEXT, documents, ordered, pairs, texts

from tradeloom.llm import brown, imi, warc, wordblocks
from tradeloom.llm.common import stage


def recorded(rows):
    last = (1 << 63) - 1
    payloads = [(p, (h or "").encode()) for p, h in rows]
    first = {}
    for p, b in payloads:
        k = hashlib.sha256(b).hexdigest()
        first[k] = min(first.get(k, last), last if p is None else p)
    out = []
    for p, b in payloads:
        k = hashlib.sha256(b).hexdigest()
        again = len(b) >= 100 and first[k] < (last if p is None else p)
        out.append((p, len(b), k, "revisit" if again else "response", first[k] if again else None))
    return out


LONG = "<p>é</p>" * 30
PAGES = [
    (5, "http://x/ a\r\nb", LONG), (3, None, LONG), (None, "u", LONG), (None, "u", LONG), (3, "u", LONG), (7, "u", None),
    (8, "u", ""), (9, "u", "\r\n\r\nWARC/1.1" * 3), (1, "u", "x" * 99), (2, "u", "x" * 99), (11, "u", "x" * 100),
    (12, "u", "x" * 100), (13, "u", "y" * 1_000_000),
]
PAGE = "page_id long, url string, html string"


def test_records_survive_the_round_trip(spark):
    for frame in (spark.createDataFrame(PAGES, PAGE), spark.read.parquet(f"{SF_DIR}/pages.parquet")):
        got = [tuple(r) for r in warc.round_trip(frame).collect()]
        assert ordered(got) == ordered(recorded([(r.page_id, r.html) for r in frame.collect()]))
    assert warc.round_trip(spark.createDataFrame([], PAGE)).count() == 0


def test_bundles_are_zstandard_and_records_are_found_by_the_index(spark):
    path, index = warc.write(spark.createDataFrame(PAGES, PAGE).coalesce(1))
    files = {f: open(f, "rb").read() for f in glob.glob(path.removeprefix("file://") + "/part-*")}
    whole = []
    for data in files.values():
        reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
        whole.append(reader.read())
        assert whole[-1] == b"".join(warc.frame(data, i) for i in range(len(warc.seek_table(data))))
    assert sum(len(w) for w in whole) == sum(r.length for r in index.collect())
    found = Counter()
    for r in index.collect():
        for data in files.values():
            if r.frame < len(warc.seek_table(data)):
                content = warc.frame(data, r.frame)[r.offset : r.offset + r.length]
                if content.startswith(b"WARC/1.1") and f"WARC-Record-ID: {r.record_id}\r".encode() in content:
                    assert warc.parse(content)[2] == len(content)
                    found[r.record_id] += 1
    assert found == Counter(warc.record_id(p) for p, _, _ in PAGES)


def nearest(rows, asked):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v):
            good[i] = np.array(v, float)
    ids, x = np.array(list(good)), np.array(list(good.values()))
    out = {}
    for i, v in good.items():
        if asked(i):
            d = np.sqrt(((x - v) ** 2).sum(1))
            out[i] = [(float(d[j]), int(ids[j])) for j in np.lexsort((ids, d)) if ids[j] != i][:10]
    return out


def searched(frame, asked):
    out = {}
    for r in imi.search(frame, asked).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


VECTOR = "vec_id long, embedding array<float>"


def test_recall_and_scores(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    x = (centres[rng.integers(0, 40, size=6000)] + 0.3 * rng.normal(size=(6000, 16))).astype(np.float32)
    x[::3] = x[0]  # a third of all rows hold one vector
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    got, want = searched(spark.createDataFrame(rows, VECTOR), lambda i: i % 50 == 0), nearest(rows, lambda i: i % 50 == 0)
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9
    assert got[0] == want[0]


def test_recall_on_the_table(spark):
    frame = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got, want = searched(frame, lambda i: i % 10 == 0), nearest(rows, lambda i: i % 10 == 0)
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
        (None, [1.0, 1.0]), (6, [2.0, 0.0]), (7, []), (8, [-0.0, 1.0]), (100, [1.0, 0.0]), (200, [0.0, 1.0]), (200, [0.0, 1.0]),
    ]
    asked = lambda i: i % 100 == 0
    assert searched(spark.createDataFrame(rows, VECTOR), asked) == nearest(rows, asked)
    for some in ([], [(0, None)], [(0, [0.0, 0.0])], [(0, [1.0, 2.0])]):
        assert searched(spark.createDataFrame(some, VECTOR), asked) == {}


def test_cells_come_in_order():
    rng = np.random.default_rng(2)
    near, far = rng.random(7), rng.random(9)
    counts = rng.integers(0, 3, size=63)
    cells = imi.traverse(near, far, counts, 1 << 30)
    sums = [near[c // 9] + far[c % 9] for c in cells]
    assert sums == sorted(sums) and sorted(cells) == np.flatnonzero(counts).tolist()


def scored(rows):
    def tokens(t):
        return (t or "").encode().lower().split() + [b"\n"]

    train = Counter()
    for d, t in rows:
        if d is not None and zlib.crc32(str(d).encode()) % 5 != 1:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    out = []
    for d, t in rows:
        w = tokens(t)
        base = sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        held = None if d is None else zlib.crc32(str(d).encode()) % 5 == 1
        out.append((d, held, len(w), sum(train[x] > 0 for x in w), n, round(base, 4)))
    return out


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_counts_and_unigram_scores(spark, source):
    odd = [(None, "a b"), (1, None), (2, ""), (3, "A a A É"), (3, "A a A É"), (4, "x" * 9000), (5, "a " * 9000), (6, "a b")]
    frame = texts(spark, odd) if source == "odd" else documents(spark)
    got = [tuple(r)[:5] + (round(r.base_score, 4),) for r in brown.score(frame).collect()]
    assert ordered(got) == ordered(scored(pairs(frame)))
    assert brown.score(spark.createDataFrame([], TEXT)).count() == 0


def test_classes_beat_single_words(spark):
    """On held-out texts of the table."""
    rows = [r for r in brown.score(documents(spark)).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_probabilities_sum_to_one():
    """Over all known words and an unknown one of each class, after any class."""
    rng = np.random.default_rng(1)
    top = [b"w%d" % i for i in range(5)]
    n = 1 + brown.ENDINGS + len(top)
    pairs_ = rng.integers(0, 5, size=(n, n)).astype(float)
    pairs_[0, 0] = 0
    of = brown.exchange(pairs_, 6)
    distinct = np.concatenate([[0], np.zeros(brown.ENDINGS), np.ones(len(top))])
    groups = pairs_[:, 1 : 1 + brown.ENDINGS].sum(0)
    distinct[1 : 1 + brown.ENDINGS] = 1  # each group holds one word
    model = brown.Model(pairs_, of, top, distinct, int(pairs_.sum()), n)
    inside = np.zeros(int(of.max()) + 1)
    counts = np.concatenate([groups, pairs_[:, 1 + brown.ENDINGS :].sum(0)])
    np.add.at(inside, of[1:], 10 ** model.emission(counts, of[1:]))
    inside += 10 ** model.emission(np.zeros(len(inside)), np.arange(len(inside)))  # the unknown word
    assert np.allclose(inside[1:], 1) and np.allclose((10**model.log_class).sum(1), 1)


def test_exchange_finds_classes():
    """Words of two kinds that alternate."""
    n = 21
    pairs_ = np.zeros((n, n))
    left, right = np.arange(1, 11), np.arange(11, 21)
    rng = np.random.default_rng(0)
    shuffled = rng.permutation(np.arange(1, n))
    left, right = shuffled[:10], shuffled[10:]
    pairs_[np.ix_(left, right)] = 20
    pairs_[np.ix_(right, left)] = 20
    of = brown.exchange(pairs_, 3)
    assert len(set(of[left])) == len(set(of[right])) == 1 and of[left[0]] != of[right[0]] and of[0] == 0


def test_rare_words_move_by_their_own_neighbours(spark):
    """Beyond the top, words of two kinds, mixed in each group of endings, follow different words."""
    rng = np.random.default_rng(3)
    kinds = rng.permutation(np.arange(200) % 2)
    rare = [[f"w{i:04d}" for i in np.flatnonzero(kinds == k)] for k in (0, 1)]
    lines = [" ".join(f"pre{k} lead{k} {rng.choice(rare[k])}" for _ in range(20)) for k in (0, 1) * 300]
    got = [r for r in brown.score(texts(spark, list(enumerate(lines))), top=4, classes=10).collect() if r.held_out]
    # a text's first word tells its kind; after that only the rare words, 1 in 100 each, are uncertain
    bits = sum(math.log10(2) + (r.n_tokens - 1) / 3 * math.log10(100) for r in got)
    assert got and -sum(r.score for r in got) < 1.1 * bits


def test_sweeps_go_on_until_no_item_gains():
    rng = np.random.default_rng(5)
    pairs_ = rng.poisson(3, size=(160, 160)).astype(float)
    of = brown.exchange(pairs_, 20, 0)
    both = np.zeros((20, 20))
    np.add.at(both, (of[:, None], of[None, :]), pairs_)
    best = brown.information(both)
    for w in range(1, len(of), 7):
        for b in range(1, 20):
            moved = of.copy()
            moved[w] = b
            both = np.zeros((20, 20))
            np.add.at(both, (moved[:, None], moved[None, :]), pairs_)
            assert brown.information(both) <= best + 1e-6


def test_fingerprints_cover_whole_texts_and_ids():
    def mark(doc_id, text):
        block = wordblocks._Block(0)
        block.add(doc_id, text, True, True)
        return block.close(4)[3]

    head = b"w " * 40
    assert len({mark(1, head + b"a"), mark(1, head + b"b"), mark(2, head + b"a"), mark(None, head + b"a")}) == 4


def test_vectors_of_one_component(spark):
    rows = [(i, [float(i * i)]) for i in range(1, 31)] + [(40, [0.0]), (41, [None]), (42, [float("nan")]), (43, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.rank, r.vec_id, r.score) for r in imi.search(frame, lambda i: i == 10, top=3).collect()}
    assert got == {(1, 9, 19.0), (2, 11, 21.0), (3, 8, 36.0)}


def test_scores_do_not_depend_on_parts_or_order(spark):
    """Other numbers of partitions, of blocks and another order of the rows: each text scores the same."""
    frame = documents(spark).select("doc_id", "text")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n, rows in ((4, frame), (3, frame.repartition(5)), (13, frame.orderBy("text"))):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            own = stage(rows, "order")
            found.append(sorted((r.doc_id, r.score, r.base_score) for r in brown.score(own, top=200, classes=12).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) > 100


def test_lots_are_even_and_differ_by_round():
    marks = np.arange(10_000, dtype=np.uint64)
    lots = [brown._lots(marks, turn) for turn in (1, 2)]
    assert all(abs((x < 0.25).mean() - 0.25) < 0.02 for x in lots)
    assert abs(np.corrcoef(*lots)[0, 1]) < 0.05
