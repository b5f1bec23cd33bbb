"""A Merkle manifest of a table: checkpoint and recompute.

Every row is a leaf. Leaves with one key (for documents the language) form a tree, in the order of their ids; the roots of these
trees, in the order of the keys, form the tree above them. Of each tree only every ``STRIDE``-th level is written. A proof needs
the siblings on the way from a leaf to the root: the aligned subtrees between two written levels are made anew from the stored
nodes at their feet, 2 ** STRIDE at most, each node of the foot takes its siblings from there, and the subtree is forgotten.
What stands above is joined once per subtree, not once per leaf.

No tree is held by one task: positions come from counts per range of leaves, and a subtree is a group of at most 2 ** STRIDE
rows, however large its tree is.

Nulls are encoded as ``-``, so a null and an empty text differ. A null id comes first, as does a null key; rows of one id are
ordered by their leaf; repeated rows are leaves of their own. An empty table has no root (None) and no proofs. A tree with a
single leaf is that leaf.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import stage
from tradeloom.llm.places import placed

STRIDE = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A step of a proof: the sibling's digest (empty if the run has but one node), and whether it stands first.
PATH = "array<struct<node:string,first:boolean>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(*map(encoded, fields))


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(path, start, lambda h, x: F.when(x["first"], digest(x["node"], h)).otherwise(digest(h, x["node"])))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: x["node"]), ""), 256)


def _levels(nodes: Column, steps: Column) -> Column:
    """The levels of a subtree, its foot first: ``steps`` more than that."""

    def halved(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.shiftright(F.size(level) + 1, 1) - 1)
        return F.transform(runs, lambda i: digest(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))))

    grown = F.aggregate(F.sequence(F.lit(1), steps), F.array(nodes), lambda done, _: F.concat(done, F.array(halved(F.element_at(done, -1)))))
    return F.when(steps > 0, grown).otherwise(F.array(nodes))


class Tree:
    """Trees over ``rows`` (tree, node, and what ``order`` and ``carried`` name), with every ``stride``-th level stored."""

    def __init__(self, rows: DataFrame, order: list[str], carried: list[str], stride: int = STRIDE, name: str = "merkle"):
        self.stride, self.carried = stride, carried
        self.stored = [placed(rows, ["tree"], order, f"{name}-leaves")]
        while (self.stored[-1].agg(F.max("size")).first()[0] or 1) > 1:
            top = F.element_at(F.element_at(_levels(F.col("foot")["node"], F.col("steps")), -1), 1)
            above = F.shiftright(F.col("size") + (2**stride - 1), stride)
            self.stored.append(stage(self._subtrees(len(self.stored) - 1).select("tree", "place", top.alias("node"), above.alias("size")), name))

    def _subtrees(self, level: int) -> DataFrame:
        """tree, place (that of the subtree's top in the next stored level), size (of the foot's level), foot, steps."""
        rows = self.stored[level]
        more = self.carried if level == 0 else []
        foot = F.sort_array(F.collect_list(F.struct("place", "node", *more))).alias("foot")
        # the levels to climb: all of the stride, or what is left in a tree with no other subtree at this level
        left = F.ceil(F.log2(F.col("size").cast("double"))).cast("int")
        steps = F.when(F.col("size") > 2**self.stride, self.stride).otherwise(left)
        found = rows.groupBy("tree", F.shiftright("place", self.stride).alias("top"), "size").agg(foot)
        return found.select("tree", F.col("top").alias("place"), "size", "foot", steps.alias("steps"))

    def roots(self) -> DataFrame:
        """tree and node: one row for each tree."""
        return self.stored[-1].select("tree", "node")

    def proofs(self, above: DataFrame) -> DataFrame:
        """tree, node, path (leaf to root) and the carried columns of each leaf.

        ``above`` has for each tree how it goes on from its root: tree, path; further columns are handed on.
        """
        more = [c for c in above.columns if c not in ("tree", "path")]
        paths = above.withColumn("place", F.lit(0).cast("bigint"))
        for level in range(len(self.stored) - 2, -1, -1):
            grown = self._subtrees(level).withColumn("levels", _levels(F.col("foot")["node"], F.col("steps")))
            grown = grown.join(paths, ["tree", "place"])

            def own(i: Column) -> Column:
                def step(k: Column) -> Column:
                    at = F.call_function("shiftright", i, k)
                    sibling = F.get(F.get("levels", k), at.bitwiseXOR(F.lit(1)))
                    return F.struct(F.coalesce(sibling, F.lit("")).alias("node"), (at.bitwiseAND(F.lit(1)) == 1).alias("first"))

                return F.when(F.col("steps") > 0, F.transform(F.sequence(F.lit(0), F.col("steps") - 1), step)).otherwise(F.array().cast(PATH))

            each = F.transform("foot", lambda x, i: F.struct(x.alias("x"), F.concat(own(i), F.col("path")).alias("path")))
            kept = ["place", "node", *(self.carried if level == 0 else [])]
            paths = grown.select("tree", *more, F.explode(each).alias("e")).select("tree", *more, *[f"e.x.{c}" for c in kept], "e.path")
        if len(self.stored) == 1:  # no tree has a second leaf
            paths = self.stored[0].join(paths.drop("place"), "tree")
        return paths.drop("place", "size")


class Manifest:
    """The manifest of ``rows``: a tree for each value of ``key``, and one over their roots.

    ``fields`` make the leaf; ``order`` is the column that leaves of a tree ascend by. ``carried`` are further columns that
    the proofs shall hold.
    """

    def __init__(self, rows: DataFrame, fields: Sequence[str], key: str, order: str, carried: dict[str, Column] | None = None, stride: int = STRIDE):
        carried = carried or {}
        tree = F.coalesce(F.concat(F.lit("1"), F.col(key).cast("string")), F.lit("0"))  # a null key stands first
        leaves = rows.select(tree.alias("tree"), leaf([F.col(f) for f in fields]).alias("node"), F.col(order).alias(order), *[c.alias(n) for n, c in carried.items()])
        leaves = stage(leaves, "merkle-rows")  # texts are read once; what is dealt out holds digests
        self.trees = Tree(leaves, [order, "node"], [order, *carried], stride)
        subroots = self.trees.roots().select(F.lit("").alias("tree"), "node", F.col("tree").alias("own"))
        self.top = Tree(subroots, ["own"], ["own"], stride, "merkle-top")
        found = self.top.roots().first()
        self.root = found and found["node"]

    def proofs(self) -> DataFrame:
        """Per row: tree, node (its leaf), the order column, the carried ones, subroot, and path, the siblings up to the root."""
        nothing = self.top.roots().select("tree", F.array().cast(PATH).alias("path"))
        above = self.top.proofs(nothing).select(F.col("own").alias("tree"), F.col("node").alias("subroot"), "path")
        return self.trees.proofs(above)


def verified(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """Each document's leaf and proof, and the root that follows if some documents have been tampered with.

    Tampered with are those whose id's crc32 is a multiple of 7: they show ``n_chars`` plus 1.
    """
    shown = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    docs = docs.select(*[F.col(f).cast("bigint" if f in ("doc_id", "n_chars") else "string").alias(f) for f in FIELDS])
    manifest = Manifest(docs, FIELDS, "lang", "doc_id", {"shown": F.when(tampered, leaf(shown))}, stride)
    return manifest.proofs().select(
        "doc_id", F.col("node").alias("leaf"), "subroot", F.lit(manifest.root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), folded(F.coalesce("shown", "node"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
