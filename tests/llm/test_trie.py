"""The prefix trie against a plain counterpart."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from helpers import SF_DIR, ordered
from pyspark.sql import functions as F

from tradeloom.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, size string, digest int, depth int"


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[c].append((turn is not None, turn or 0, role.encode(), tie, (role, text)))
    convs = {c: [x[-1] for x in sorted(v)] for c, v in convs.items()}
    members, ends, built = defaultdict(list), defaultdict(list), {}
    for c, own in sorted(convs.items()):
        h = zlib.crc32(str(c).encode()) % 6
        lead = c - (abs(c) % 100) * (1 if c > 0 else -1)
        built[c] = tuple(convs.get(lead, [])[:h] + own[h:])
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
        ends[built[c]].append(c)
    children = defaultdict(set)
    for k in members:
        if k:
            children[k[:-1]].add(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
    return [
        (m[0], len(k), members[k[:-1]][0] if k else None, len(m), len(children[k]), leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest())
        for k, m in members.items()
    ]


def check(spark, rows, page=trie.PAGE):
    frame = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    assert ordered(map(tuple, trie.prefix_trie(frame, page).collect())) == ordered(plain(rows))


def branching(n, alphabet, length):
    """Conversations whose turns are drawn from a few texts, so that they part at all depths."""
    rows = []
    for c in range(n):
        x = zlib.crc32(f"seed{c}".encode())
        for t in range(x % length):
            x = (x * 1103515245 + 12345) % 2**31
            rows.append((c * 37 - 900, t, "user", f"t{(x >> 8) % alphabet}"))
    return rows


@pytest.mark.parametrize("page", [trie.PAGE, 3])
def test_branching_at_all_depths(spark, page):
    check(spark, branching(120, 2, 12), page)


def test_chains(spark):
    """Every conversation is a prefix of the next."""
    check(spark, [(c * 100, t, "user", "é" * t) for c in range(1, 25) for t in range(c)])


@pytest.mark.parametrize("page", [trie.PAGE, 4])
def test_nulls_ties_repeats_and_long_ones(spark, page):
    rows = [(None, 1, "user", "x"), (100, None, None, None), (100, None, "user", ""), (100, 3, "user", "b"), (100, 3, "user", "a")]
    rows += [(101, 5, "user", "x")] * 4 + [(c, t, None, "same") for c in (201, 202, 203, 300) for t in (1, 2)]
    rows += [(401, 0, "user", "ü" * 50_000), (-7, 1, "a", "b"), (-100, 1, "a", "b"), (7, 1, "ab", ""), (0, 1, "a", "b")]
    rows += [(500, t, "user", str(t % 3)) for t in range(60)] + [(600, t, "user", str(t % 3)) for t in range(45)]
    check(spark, rows, page)


def test_no_conversations(spark):
    check(spark, [])
    check(spark, [(None, 1, "user", "x")])


def test_table(spark):
    frame = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert ordered(map(tuple, trie.prefix_trie(frame).collect())) == ordered(plain(rows))


def test_fattest(spark):
    rows = spark.range(64).select(F.col("id").alias("a")).crossJoin(spark.range(64).select(F.col("id").alias("b"))).filter("a < b")
    got = rows.select("a", "b", trie.fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for r in got:
        assert r.f == max(range(r.a + 1, r.b + 1), key=lambda x: x & -x)


def test_batches_are_few(spark):
    """A trie that is one long chain of branches takes batches by the logarithm of its size."""
    rows = [(c, t, "user", "a" if t < c else f"end{c}") for c in range(1, 65) for t in range(c + 1)]
    frame = spark.createDataFrame(rows, "sid long, depth long, role string, text string")
    own = frame.select("sid", (F.col("depth") + 1).alias("depth"), F.unhex(F.md5("text")).alias("digest"), F.lit(1).cast("bigint").alias("chars"))
    built = trie.Trie(own.groupBy("sid").agg(F.max("depth").alias("len")), trie.Sequences(own))
    assert built.batches < 20
    assert built.nodes.count() == 64 + 63
