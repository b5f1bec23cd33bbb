"""The Merkle manifest against a plain counterpart."""

import hashlib
import zlib

import pytest
from helpers import ordered

from tradeloom.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, tree int, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    i, text, lang, source, n = row[:5]
    fields = [i, source, lang, None if n is None else n + more, text]
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields])


def tree(nodes):
    """Root and, for each leaf, its siblings with their sides."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            if i ^ 1 < len(nodes):
                paths[k].append((nodes[i ^ 1], i & 1))
            else:
                paths[k].append(("", 0))
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], paths


def plain(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        own = sorted(langs[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *tree([leaf(r) for r in own])))
    if not trees:
        return []
    root, tops = tree([t[1] for t in trees])
    found = []
    for (own, subroot, paths), top in zip(trees, tops, strict=True):
        for row, path in zip(own, paths, strict=True):
            path = path + top
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            fold = leaf(row, 1 if tampered else 0)
            for node, first in path:
                fold = h(node, fold) if first else h(fold, node)
            found.append((row[0], leaf(row), subroot, root, h(*[p[0] for p in path]), fold, fold == root))
    return found


def check(spark, rows, stride):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    assert ordered(map(tuple, merkle.verified(docs, stride).collect())) == ordered(plain(rows))


ODD = [
    (None, None, None, None, None),
    (None, "a", None, "s", 1),
    (3, "", "", None, 0),
    (3, "", "", None, 0),
    (3, "ü" * 70_000, "", "s", 70_000),
    (-5, "b", "ß", None, None),
    (7, "b", "z", None, 2),
]


@pytest.mark.parametrize("stride", [1, 3])
def test_trees_of_all_sizes(spark, stride):
    rows = [(i * 5, f"t{i}", lang, "s", i) for lang, n in (("en", 37), ("de", 8), ("fr", 1), ("es", 9)) for i in range(n)]
    check(spark, rows + ODD, stride)


@pytest.mark.parametrize("rows", [[], ODD[:1], [ODD[2]] * 5, [(7, "b", "z", None, 2), (14, "c", "y", "s", 1)]])
def test_small_tables(spark, rows):
    check(spark, rows, merkle.STRIDE)


def test_any_change_of_a_field_shows(spark):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in [(i, "t", "en", "s", 1) for i in range(20)]], SCHEMA)
    roots = {merkle.Manifest(docs, merkle.FIELDS, "lang", "doc_id").root}
    for change in ("replace(text, 't', if(doc_id = 11, 'u', 't')) as text", "if(doc_id = 19, null, source) as source"):
        name = change.rsplit(" ", 1)[1]
        changed = docs.selectExpr(*[c for c in docs.columns if c != name], change)
        roots.add(merkle.Manifest(changed, merkle.FIELDS, "lang", "doc_id").root)
    assert len(roots) == 3
