"""The prefix trie of conversations: a z-fast trie built in batches.

A conversation is a sequence of turns, a turn the digest of its role and text. Prefixes are told apart by 128-bit hashes, chained
from turn to turn, so a conversation carries the hash of each of its prefixes; equal conversations are one sequence.

The trie is compacted: a node covers the depths from ``low`` (its parent's depth) to ``ext``, and a table holds it under the hash of
the prefix at its handle, the 2-fattest number in (low, ext], that is the one with the most trailing zero bits. A sequence finds
its exit node by fat binary search: it asks the table for its own prefix at the 2-fattest depth of what is left of its length, goes
on below the node if there is one and above that depth if not, so the logarithm of its length is the number of joins. How far it
agrees with the exit node's own sequence gives the place where it leaves the trie.

Sequences are inserted in batches. Of those that leave the trie at the same place with the same next turn, one, chosen by a hash,
is inserted in this batch, and all nodes are split where a sequence leaves them; the others look again. As the choice doesn't depend
on the sequences' content, the number of batches grows with the logarithm of their number.

Sums over subtrees are made on the compacted nodes by doubling: each node adds what its descendants 1, 2, 4, ... nodes below hold.
At last every node's edge is expanded to one row for each depth.

No conversation, node or group is held by one task: positions come from counts per range, hashes are kept in pages of ``PAGE``
turns, joins meet their unique side from written tables (so that Spark can split the other), sums are pre-aggregated, and the
conversation ids behind a digest are strung together in pieces before one task streams those pieces through the digest.

Turns of one conversation are ordered by turn (null first), then by role and by the turn's digest; a null role or text is empty.
Rows without a ``conv_id`` belong to no conversation. Repeated rows are turns of their own. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import stage
from tradeloom.llm.places import placed
from tradeloom.operators.blocks import next_value

PAGE = 1024
WIDTH = 16
#: Bytes of a piece of the list of conversations that end at a node.
PIECE = 1 << 16
#: Conversations whose id is a multiple of ``GROUP`` lend up to ``SHARED`` - 1 turns to those that follow.
GROUP, SHARED = 100, 6
NODE = "rep bigint, low bigint, ext bigint, f bigint, handle binary, name binary, up binary, key binary"


def empty() -> Column:
    return F.unhex(F.lit(""))


def turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), size (of the conversation), digest and chars (code points of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    conv_id, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    own = rows.select(conv_id.alias("conv_id"), turn.alias("turn"), role.alias("role"), digest.alias("digest"), F.length(text).cast("bigint").alias("chars"))
    return placed(own.filter("conv_id is not null"), ["conv_id"], ["turn", "role", "digest"], "turns").drop("turn", "role")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, len) of all conversations, and (sid, depth, digest, chars) of their turns, after each has exchanged its first
    h turns, h = crc32(conv_id) % SHARED, for those of the conversation that leads its group of ids."""
    rows = stage(rows, "turns-placed")
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("bigint")
    lead = F.col("conv_id") - F.col("conv_id") % GROUP
    first = F.sort_array(F.collect_list(F.struct("place", "digest", "chars")))
    heads = rows.filter((F.col("conv_id") == lead) & (F.col("place") < SHARED - 1)).groupBy(F.col("conv_id").alias("lead")).agg(first.alias("head"))
    convs = rows.filter("place = 0").select("conv_id", "size", h.alias("h"), lead.alias("lead")).join(heads, "lead", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<place:bigint,digest:binary,chars:bigint>>"))
    convs = convs.select("conv_id", "h", head.alias("head"), F.greatest(F.col("size") - F.col("h"), F.lit(0)).alias("own"))
    convs = stage(convs.withColumn("len", F.size("head") + F.col("own")), "conversations")
    shift = convs.filter("own > 0").select("conv_id", F.col("h").alias("_h"), F.size("head").cast("bigint").alias("_k"))
    own = rows.join(shift, "conv_id").filter("place >= _h")
    own = own.select(F.col("conv_id").alias("sid"), (F.col("place") - F.col("_h") + F.col("_k") + 1).alias("depth"), "digest", "chars")
    lent = convs.select(F.col("conv_id").alias("sid"), F.explode("head").alias("x"))
    return convs.select("conv_id", "len"), own.union(lent.select("sid", (F.col("x.place") + 1).alias("depth"), "x.digest", "x.chars"))


class Sequences:
    """The hashes of all prefixes of each sequence, in pages of ``size`` turns: (sid, page, hashes, sums), where sums are the
    code points of the prefixes."""

    def __init__(self, rows: DataFrame, size: int = PAGE):
        self.size = size
        rows = rows.withColumn("page", F.floor((F.col("depth") - 1) / size).cast("bigint"))
        rows = rows.repartition("sid", "page").sortWithinPartitions("sid", "page", "depth")
        kind = "sid bigint, page bigint, hashes binary, sums array<bigint>"
        self.pages = stage(rows.select("sid", "page", "digest", "chars").mapInArrow(_chained, kind), "pages")
        self.single = (self.pages.agg(F.max("page")).first()[0] or 0) == 0
        if not self.single:  # what the pages before hold goes into every hash and sum
            ends = self.pages.select("sid", "page", F.substring("hashes", -WIDTH, WIDTH).alias("end"), F.element_at("sums", -1).alias("sum"))
            ends = ends.repartition("sid").sortWithinPartitions("sid", "page")
            before = ends.mapInArrow(_carried, "sid bigint, page bigint, carry binary, sum bigint")
            joined = self.pages.join(stage(before, "carries"), ["sid", "page"])
            self.pages = stage(joined.mapInArrow(_continued, kind), "pages")

    def held(self, rows: DataFrame, sid: str) -> DataFrame:
        """``rows`` with the hashes of their sequence beside them, if they are one page at most."""
        if not self.single:
            return rows
        own = self.pages.select(F.col("sid").alias(sid), F.col("hashes").alias(f"{sid}_hashes"))
        return rows.join(own, sid, "left")

    def hash_at(self, rows: DataFrame, sid: str, depth: Column, name: str) -> DataFrame:
        """Add the hash of the first ``depth`` turns, null if that is null; the rows must be ``held``."""
        if self.single:
            return rows.withColumn(name, F.when(depth == 0, empty()).otherwise(_cut(F.col(f"{sid}_hashes"), depth)))
        found = self._paged(rows, sid, depth, "hashes")
        own = F.when(F.col("_d") == 0, empty()).otherwise(_cut(F.col("_x"), F.pmod(F.col("_d") - 1, F.lit(self.size)) + 1))
        return found.withColumn(name, own).drop("_d", "_p", "_x")

    def sum_at(self, rows: DataFrame, sid: str, depth: Column, name: str) -> DataFrame:
        """Add the code points of the first ``depth`` turns."""
        found = self._paged(rows, sid, depth, "sums")
        own = F.coalesce(F.get("_x", F.pmod(F.col("_d") - 1, F.lit(self.size))), F.lit(0))
        return found.withColumn(name, F.when(F.col("_d") == 0, 0).otherwise(own)).drop("_d", "_p", "_x")

    def _paged(self, rows: DataFrame, sid: str, depth: Column, what: str) -> DataFrame:
        own = self.pages.select(F.col("sid").alias(sid), F.col("page").alias("_p"), F.col(what).alias("_x"))
        page = F.floor((F.greatest(F.col("_d"), F.lit(1)) - 1) / self.size).cast("bigint")
        return rows.withColumn("_d", depth.cast("bigint")).withColumn("_p", page).join(own, [sid, "_p"], "left")

    def agreed(self, rows: DataFrame, sid: str, other: str, lo: str, hi: str, longest: int) -> DataFrame:
        """Raise ``lo``, up to which two sequences agree, as far as they do, but not beyond ``hi``."""
        if self.single:
            rows = self.held(rows, other)
            same = F.filter(
                F.sequence(F.col(lo) + 1, F.col(hi)), lambda d: _cut(F.col(f"{sid}_hashes"), d) == _cut(F.col(f"{other}_hashes"), d)
            )
            return rows.withColumn(lo, F.when(F.col(lo) < F.col(hi), F.col(lo) + F.size(same)).otherwise(F.col(lo)))
        for _ in range(longest.bit_length()):
            middle = F.floor((F.col(lo) + F.col(hi) + 1) / 2).cast("bigint")
            rows = self.hash_at(self.hash_at(rows.withColumn("_m", middle), sid, F.col("_m"), "_a"), other, F.col("_m"), "_b")
            rows = rows.withColumns({lo: F.when(F.col("_a") == F.col("_b"), F.greatest(lo, "_m")).otherwise(F.col(lo)), hi: F.when(F.col("_a") == F.col("_b"), F.col(hi)).otherwise(F.col("_m") - 1)})
            rows = rows.drop("_m", "_a", "_b")
        return rows


def _cut(hashes: Column, depth: Column) -> Column:
    return F.substring(hashes, ((depth - 1) * WIDTH + 1).cast("int"), F.lit(WIDTH))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the turns of pages, in order, to pages."""
    key, state, hashes, sums, done = None, b"", [], [], []

    def page():
        return (*key, b"".join(hashes), sums)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("sid", "page", "digest", "chars")]
        for sid, number, digest, chars in zip(*columns, strict=True):
            if (sid, number) != key:
                if key:
                    done.append(page())
                key, state, hashes, sums = (sid, number), b"", [], []
            state = hashlib.md5(state + digest).digest()
            hashes.append(state)
            sums.append(chars + (sums[-1] if sums else 0))
        if done:
            yield _pages(done)
            done = []
    if key:
        yield _pages([page()])


def _pages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"sid": pa.int64(), "page": pa.int64(), "hashes": pa.binary(), "sums": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page what the pages before it come to: a hash (empty for the first) and a sum."""
    own, carry, total = None, b"", 0
    for batch in batches:
        carries, totals = [], []
        for sid, end, n in zip(*(batch.column(c).to_pylist() for c in ("sid", "end", "sum")), strict=True):
            if sid != own:
                own, carry, total = sid, b"", 0
            carries.append(carry)
            totals.append(total)
            carry, total = hashlib.md5(carry + end).digest() if carry else end, total + n
        columns = [batch.column("sid"), batch.column("page"), pa.array(carries, pa.binary()), pa.array(totals, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["sid", "page", "carry", "sum"])


def _continued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = []
        for r in batch.to_pylist():
            h, carry = r["hashes"], r["carry"]
            if carry:
                h = b"".join(hashlib.md5(carry + h[i : i + WIDTH]).digest() for i in range(0, len(h), WIDTH))
            done.append((r["sid"], r["page"], h, [x + r["sum"] for x in r["sums"]]))
        if done:
            yield _pages(done)


def fattest(low: Column, high: Column) -> Column:
    """The 2-fattest number in (low, high]."""
    bit = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, bit), bit)


class Trie:
    """The compacted trie of ``strings`` (sid, len, end: the hash of the whole): ``nodes`` as in ``NODE``.

    ``rep`` is a sequence through the node, ``key`` and ``up`` the hashes at ``ext`` and ``low``, ``name`` that at ``low`` + 1.
    """

    def __init__(self, strings: DataFrame, sequences: Sequences):
        self.sequences = sequences
        spark = strings.sparkSession
        self.nodes = spark.createDataFrame([], NODE)
        pending, self.batches = strings.select("sid", "len"), 0
        while (longest := pending.agg(F.max("len")).first()[0]) is not None:
            found = stage(self.located(pending, longest if self.batches else 0, longest), "located")
            chosen = stage(
                found.filter("next is not null").groupBy("next").agg(F.min(F.struct(F.xxhash64("sid").alias("h"), "sid", "len", "lcp")).alias("x")).select("x.*"),
                "chosen",
            )
            self.nodes = stage(self._grown(found, chosen), "nodes")
            pending = stage(found.filter("next is not null").join(chosen.select("sid"), "sid", "left_anti").select("sid", "len"), "pending")
            self.batches += 1

    def located(self, pending: DataFrame, deepest: int, longest: int) -> DataFrame:
        """Where each sequence leaves the trie: lcp, the depth; next, the hash one turn further (null if it ends there); and the
        edge to be split there, if it isn't a node's end: edge (its key), rep, low, ext."""
        s, c = self.sequences, F.col
        state = s.held(pending, "sid").withColumns({"a": F.lit(0).cast("bigint"), "b": c("len")})
        state = state.withColumns({f"x_{n}": F.lit(None).cast(t) for n, t in (("rep", "bigint"), ("low", "bigint"), ("ext", "bigint"), ("f", "bigint"), ("key", "binary"))})
        table = self.nodes.select("handle", *[c(n).alias(f"_{n}") for n in ("rep", "low", "ext", "f", "key")])
        for _ in range(deepest.bit_length()):
            state = s.hash_at(state.withColumn("at", F.when(c("a") < c("b"), fattest(c("a"), c("b")))), "sid", c("at"), "handle")
            state = state.join(table, "handle", "left").withColumns(
                {"a": F.coalesce("_ext", "a"), "b": F.when(c("at").isNull() | c("_key").isNotNull(), c("b")).otherwise(c("at") - 1)}
                | {f"x_{n}": F.coalesce(f"_{n}", f"x_{n}") for n in ("rep", "low", "ext", "f", "key")}
            )
            state = state.drop("handle", "at", *[f"_{n}" for n in ("rep", "low", "ext", "f", "key")])
        # does the sequence agree with all of the node found, and has that a child for its next turn?
        state = s.hash_at(state, "sid", F.when(c("len") >= c("x_ext"), c("x_ext")), "here")
        state = state.withColumns({"whole": c("x_key").isNull() | F.coalesce(c("here") == c("x_key"), F.lit(False)), "e": F.coalesce("x_ext", F.lit(0))})
        state = s.hash_at(state, "sid", F.when(c("whole") & (c("len") > c("e")), c("e") + 1), "name").drop("here")
        children = self.nodes.select("name", *[c(n).alias(f"_{n}") for n in ("rep", "low", "ext", "key")])
        state = state.join(children, "name", "left")

        def edge(n: str) -> Column:
            return F.when(c("whole"), c(f"_{n}")).otherwise(c(f"x_{n}")).alias(n)

        kept = [x for x in ("sid_hashes",) if x in state.columns]
        state = state.select("sid", "len", "e", *kept, edge("rep"), edge("low"), edge("ext"), edge("key"), F.when(c("whole"), c("e") + 1).otherwise(c("x_f")).alias("lo"))
        state = state.withColumn("hi", F.least("len", "ext"))
        state = s.agreed(state, "sid", "rep", "lo", "hi", longest)
        state = state.withColumn("lcp", F.when(c("rep").isNull(), c("e")).otherwise(c("lo")))
        state = s.hash_at(state, "sid", F.when(c("len") > c("lcp"), c("lcp") + 1), "next")
        split = c("rep").isNotNull() & (c("lcp") < c("ext"))
        return state.select("sid", "len", "lcp", "next", *[F.when(split, c(n)).alias(n) for n in ("rep", "low", "ext")], F.when(split, c("key")).alias("edge"))

    def _grown(self, found: DataFrame, chosen: DataFrame) -> DataFrame:
        cuts = found.filter("edge is not null").select("edge", "rep", "low", "ext", "lcp").distinct()
        cuts = stage(cuts.withColumn("block", F.floor(F.col("lcp") / 4096)), "cuts")
        lower = next_value(cuts, ["edge"], "block", "lcp", F.col("lcp"), "until")
        lower = lower.select("rep", F.col("lcp").alias("low"), F.coalesce("until", "ext").alias("ext"))
        upper = cuts.groupBy("edge", "rep", "low").agg(F.min("lcp").alias("ext")).drop("edge")
        leaves = chosen.select(F.col("sid").alias("rep"), F.col("lcp").alias("low"), F.col("len").alias("ext"))
        kept = self.nodes.join(cuts.select(F.col("edge").alias("key")).distinct(), "key", "left_anti")
        made = self.sequences.held(upper.unionByName(lower).unionByName(leaves), "rep")
        made = made.withColumn("f", fattest(F.col("low"), F.col("ext")))
        for name, depth in (("handle", F.col("f")), ("name", F.col("low") + 1), ("up", F.col("low")), ("key", F.col("ext"))):
            made = self.sequences.hash_at(made, "rep", depth, name)
        return kept.select(*self.nodes.columns).union(made.select(*self.nodes.columns))


def member_digests(ends: DataFrame) -> DataFrame:
    """(end, ends_sha256): SHA-256 of the conversations with that whole sequence, ascending and joined by commas."""
    dealt = ends.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    pieces = dealt.mapInArrow(_strung, "end binary, first bigint, ids string")
    return pieces.repartition("end").sortWithinPartitions("end", "first").mapInArrow(_digested, "end binary, ends_sha256 string")


def _strung(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one end, as pieces of text; a run goes on in the next piece after ``PIECE`` bytes or a batch."""
    for batch in batches:
        ends, ids = batch.column("end").to_pylist(), batch.column("conv_id").to_pylist()
        rows: list[tuple] = []
        last, size = None, 0
        for end, i in zip(ends, ids, strict=True):
            if end != last or size > PIECE:
                rows.append((end, i, [str(i)]))
                last, size = end, 0
            else:
                rows[-1][2].append(str(i))
            size += len(rows[-1][2][-1]) + 1
        columns = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([",".join(r[2]) for r in rows])]
        yield pa.RecordBatch.from_arrays(columns, names=["end", "first", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, state = None, None

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["end", "ends_sha256"])

    for batch in batches:
        done = []
        for end, ids in zip(batch.column("end").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if state is None or end != own:
                if state is not None:
                    done.append((own, state.hexdigest()))
                own, state = end, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield batch_of(done)
    if state is not None:
        yield batch_of([(own, state.hexdigest())])


def summed(own: DataFrame) -> DataFrame:
    """``own`` (key, up, and numbers) with the numbers summed over each node's subtree, ``first`` as the least; by doubling."""
    sums = [c for c in own.columns if c not in ("key", "up", "first")]
    state = stage(own, "subtrees")
    while state.filter("up is not null").limit(1).count():
        below = state.filter("up is not null").groupBy("up").agg(*[F.sum(c).alias(f"_{c}") for c in sums], F.min("first").alias("_first"))
        # the root has nothing above it; rows that point to it needn't meet it
        further = state.select(F.col("key").alias("up"), F.col("up").alias("_up")).filter("_up is not null")
        grown = state.join(stage(below, "below").withColumnRenamed("up", "key"), "key", "left").join(further, "up", "left")
        state = stage(
            grown.select("key", F.col("_up").alias("up"), F.least("first", "_first").alias("first"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums]),
            "subtrees",
        )
    return state


def prefix_trie(rows: DataFrame, page: int = PAGE) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations; see ``rebuilt``."""
    convs, own_turns = rebuilt(turns(rows))
    sequences = Sequences(own_turns, page)
    last = sequences.pages.groupBy("sid").agg(F.max_by(F.substring("hashes", -WIDTH, WIDTH), "page").alias("end"))
    ends = stage(convs.join(last.withColumnRenamed("sid", "conv_id"), "conv_id", "left").withColumn("end", F.coalesce("end", empty())), "ends")
    strings = stage(ends.groupBy("end", "len").agg(F.min("conv_id").alias("sid"), F.count(F.lit(1)).alias("n")), "strings")
    trie = Trie(strings.filter("len > 0"), sequences)
    nodes = trie.nodes
    # what each node adds: its own edge's code points, and the sequences that end there
    children = nodes.groupBy(F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    own = sequences.sum_at(sequences.sum_at(nodes.select("rep", "low", "ext", "key", "up"), "rep", F.col("low"), "before"), "rep", F.col("ext"), "upto")
    counted = sequences.sum_at(strings, "sid", F.col("len"), "total").select(F.col("end").alias("key"), "n", F.col("sid").alias("first"), (F.col("n") * F.col("total")).alias("weight"))
    root = strings.sparkSession.createDataFrame([(0, 0, 0, b"", None, 0, 0)], "rep bigint, low bigint, ext bigint, key binary, up binary, before bigint, upto bigint")
    own = own.union(root.select(*own.columns)).join(counted, "key", "left").join(children, "key", "left")
    own = stage(
        own.select(
            "key", "up", "rep", "low", "ext", "before", F.coalesce("n_children", F.lit(0)).alias("n_children"), "first",
            F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("weight", F.lit(0)).alias("weight"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
            (F.col("upto") - F.col("before")).alias("edge"),
        ),
        "own",
    )
    total = summed(own.select("key", "up", "first", "n", "weight", "leaves", "edge")).drop("up")
    top = total.filter(F.col("key") == empty()).first()
    nodes = own.drop("first", "n", "weight", "leaves", "edge").join(total, "key").filter("first is not null")
    above = total.select(F.col("key").alias("up"), F.col("first").alias("above")).filter(F.length("up") > 0)
    nodes = nodes.join(above, "up", "left").withColumn("above", F.when(F.col("low") > 0, F.col("above")).when(F.col("ext") > 0, F.lit(top["first"]).cast("bigint")))
    nodes = stage(nodes.join(member_digests(ends).withColumnRenamed("end", "key"), "key", "left"), "summed")
    return _expanded(nodes, sequences)


def _expanded(nodes: DataFrame, sequences: Sequences) -> DataFrame:
    """A row for each depth of each node's edge, and the root's."""
    size = sequences.size
    pages = F.sequence(F.floor(F.col("low") / size).cast("bigint"), F.floor((F.col("ext") - 1) / size).cast("bigint"))
    each = nodes.filter("ext > 0").withColumn("page", F.explode(pages))
    each = each.join(sequences.pages.select(F.col("sid").alias("rep"), "page", "sums"), ["rep", "page"])
    # the last sum of the page before is the first's base: it is the sum at the first depth less that turn's own
    first, until = F.greatest(F.col("low"), F.col("page") * size) + 1, F.least("ext", (F.col("page") + 1) * size)
    each = each.withColumn("depth", F.explode(F.sequence(first, until)))
    each = sequences.sum_at(each, "rep", F.col("depth") - 1, "sum") if not sequences.single else each.withColumn("sum", F.coalesce(F.get("sums", F.col("depth").cast("int") - 2), F.lit(0)))
    root = nodes.filter("ext = 0").withColumns({"depth": F.lit(0).cast("bigint"), "sum": F.lit(0).cast("bigint")})
    end = F.col("depth") == F.col("ext")

    def rows(of: DataFrame) -> DataFrame:
        # members' code points from this depth on, less one copy of the subtree's
        saved = F.col("weight") - F.col("n") * F.col("sum") - (F.col("edge") - (F.col("sum") - F.col("before")))
        return of.select(
            F.col("first").alias("conv_id"), "depth",
            F.when(F.col("depth") == F.col("low") + 1, F.col("above")).when(F.col("depth") > 0, F.col("first")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"), F.when(end, F.col("n_children")).otherwise(1).alias("n_children"),
            F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
            F.when(end, F.coalesce("ends_sha256", F.sha2(empty(), 256))).otherwise(F.sha2(empty(), 256)).alias("ends_sha256"),
        )

    return rows(each).union(rows(root))
