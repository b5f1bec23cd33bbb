import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import TEXT, documents, ordered, pairs, texts
from pyspark.sql import functions as F

from tradeloom.llm import graph, minhash, recompress
from tradeloom.llm.common import sequences, stage


def near(rows):
    """Brute force: size of the set, component and kept, by row."""
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for e, both in Counter(e for x in s for e in holders[x]).items():
            if 100 * both >= 75 * (len(s) + len(sets[e]) - both):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return [(d, len(sets[d]), root(d), root(d) == d) for d, _ in rows]


def copies():
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(200):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((3 * i, " ".join(own)))
    rows += [(5000 + i, " ".join(f"z{rng.randrange(30)}" for _ in range(rng.randrange(0, 9)))) for i in range(40)]
    return rows + [(9000, None), (9001, ""), (9002, " "), (9003, "A b"), (9004, "a B"), (9005, "b a"), (9006, "É é")]


@pytest.mark.parametrize("members", [2048, 16])
def test_near_duplicates_of_one_large_group(spark, monkeypatch, members):
    """With few members to a task, the group is split and its pieces are put together again."""
    monkeypatch.setattr(minhash, "MEMBERS", members)
    rows = copies()
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(texts(spark, rows)).collect()]
    assert ordered(got) == ordered(near(rows))


def test_near_duplicates_of_the_table(spark):
    frame = documents(spark)
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame).collect()]
    assert ordered(got) == ordered(near(pairs(frame)))


def test_near_duplicates_without_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "q"), (None, None)]
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(texts(spark, rows)).collect()]
    want = [(None, 2, 3, False), (None, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (None, 1, None, True), (None, 0, None, True)]
    assert ordered(got) == ordered(want)
    assert minhash.near_duplicates(spark.createDataFrame([], TEXT)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, size=3000).astype(np.uint64) * np.uint64(2)
    found = minhash.signatures([np.sort(x[:2000]), np.sort(x[1000:])])
    assert abs((found[0] == found[1]).mean() - 1 / 3) < 0.2


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 300), (300, 250), (7, 7)]
    rng.shuffle(edges)
    got = {r.v: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 250: 200, 300: 200}
    assert got == want


def removed(rows):
    """Brute force: words, words removed and the digest of those kept, by row."""
    first, words = {}, [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def passages():
    rng = random.Random(1)
    shared = [[f"p{i}_{rng.randrange(40)}" for _ in range(rng.randrange(45, 120))] for i in range(10)]
    rows = {}
    for _ in range(250):
        w = []
        for _ in range(rng.randrange(1, 5)):
            k = rng.random()
            if k < 0.3:
                w += [f"w{rng.randrange(50)}" for _ in range(rng.randrange(5, 80))]
            elif k < 0.45:
                w += ["be"] * rng.randrange(20, 90)
            elif k < 0.6:
                w += ["x", "y"] * rng.randrange(20, 50)
            elif k < 0.7:
                w += ["q", "r", "q", "s"] * rng.randrange(10, 30)
            elif k < 0.75:
                w += ["q"] * rng.randrange(20, 60) + ["z"] * rng.randrange(20, 60)
            else:
                p = rng.choice(shared)
                w += p[rng.randrange(0, 6) : len(p) - rng.randrange(0, 4)]
        rows[rng.randrange(10**6)] = " ".join(w)
    rows = list(rows.items())
    return rows + [(9000001, None), (9000002, ""), (9000003, "  "), (9000004, rows[0][1]), (9000005, rows[0][1])]


@pytest.mark.parametrize("source", ["passages", "documents"])
def test_repeats(spark, source):
    """Also runs and periods, whose symbols differ with what surrounds a window."""
    frame = texts(spark, passages()) if source == "passages" else documents(spark)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in recompress.remove_repeats(frame).collect()]
    assert ordered(got) == ordered(removed(pairs(frame)))


def test_repeats_without_ids_and_repeated_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, long), (None, long + " x"), (3, "z\n" + long), (3, "z\n" + long), (4, f"a b\n{long}  end now"), (None, None)]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in recompress.remove_repeats(texts(spark, rows)).collect()]
    want = [(None, 60, 60, ""), (None, 61, 60, "x"), (3, 61, 0, None), (3, 61, 0, None), (4, 64, 60, "a b\nend now"), (None, 0, 0, None)]
    assert ordered(got) == ordered(want)
    assert recompress.remove_repeats(spark.createDataFrame([], TEXT)).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(7)
    middle = rng.integers(0, 6, size=70).astype(np.uint64)
    texts_ = []
    for _ in range(50):
        parts = rng.integers(0, 6, size=rng.integers(0, 40)), middle, rng.integers(0, 6, size=rng.integers(0, 40))
        texts_.append(np.concatenate(parts).astype(np.uint64))
    seen = {}
    for words, found in zip(texts_, recompress.anchors(texts_), strict=True):
        assert len(found) == max(0, len(words) - recompress.WINDOW + 1)
        for i, a in enumerate(found):
            assert seen.setdefault(words[i : i + recompress.WINDOW].tobytes(), a) == a


def test_sequences_are_told_apart_by_order():
    h = np.random.default_rng(1).integers(0, 1 << 63, size=300).astype(np.uint64)
    for size in (1, 2, 3, 5, 50, 300):
        once, twice = sequences(h, size), sequences(np.concatenate([h, h]), size)
        assert len(once) == 301 - size == len(np.unique(once))
        assert (twice[: len(once)] == once).all() and (twice[300 : 300 + len(once)] == once).all()
    assert len(sequences(h, 301)) == 0


def test_a_hub_meets_its_minimum_in_pieces(spark):
    """The join of a hub's edges is split by AQE, as both of its sides are written tables."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        rows = [(7, v) for v in range(100, 20_100)] + [(v, v + 1) for v in range(30_000, 32_000)]
        edges = stage(spark.createDataFrame(rows, "u bigint, v bigint").repartition(8), "hub")
        joined = graph.with_least(edges, F.col("m"))
        assert joined.filter("u = 7 and m = 100").count() == 20_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        found = {r.v: r.root for r in graph.components(edges.toDF("a", "b").filter("a < 30100")).collect()}
        assert all(found[v] == 7 for v in (7, 100, 5000, 20_099)) and all(found[v] == 30_000 for v in (30_000, 30_050, 30_100))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
