import os
import sys

from helpers import SF_DIR, TEXT, documents, texts

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline

import __spark_entry__ as entry
from tradeloom.llm import pii, queries
from tradeloom.llm.common import stage


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.queries()}
    assert set(queries.queries()) | {"pipeline"} <= names


def test_stages_keep_columns_and_take_effect(spark):
    docs = documents(spark)
    first = docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = stage(step(spark, docs, SF_DIR), name)
        assert after.columns == documents(spark).columns and after.schema == docs.schema
        docs = after
    assert 0 < docs.count() < first
    assert docs.filter("n_chars <> length(text)").isEmpty()
    again = pii.report(docs).agg({c: "sum" for c in ("n_email", "n_ip", "n_card", "n_phone")}).first()
    assert not any(again)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_one_of_each_group_stays(spark):
    """Against the operator's own classes, on what the first stage kept."""
    from tradeloom.llm import minhash

    docs = documents(spark)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    found = minhash.near_duplicates(docs)
    assert kept.count() == found.select("component_id").distinct().count()


def test_nulls_clashing_names_and_empty_tables(spark):
    rows = [(None, None), (1, "a b"), (1, "a b"), (2, "you a@b.com"), (None, "q " * 70), (3, "")]
    data = [(i, t, "x", "y", 1, "z") for i, t in rows]
    docs = spark.createDataFrame(data, f"{TEXT}, row string, key string, kept_text int, `a b` string")
    for some in (docs, docs.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            some = stage(step(spark, some, SF_DIR), name)
    assert some.count() == 0
    assert texts(spark, rows).count() == 6


def test_one_row_of_each_group_stays_whatever_its_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, long), (1, long), (1, f"{long} end"), (2, long), (1, other), (None, other), (4, ""), (4, ""), (None, ""), (None, "")]
    rows += [(None, "x y z"), (None, "x y z"), (None, None)]
    kept = corpus_pipeline.drop_near_duplicates(spark, texts(spark, rows), SF_DIR).collect()
    got = sorted(((r.doc_id, r.text) for r in kept), key=str)
    assert [g for g in got if g[1] == other] == [(1, other)]
    assert len([g for g in got if g[1] and g[1].startswith("w0 ")]) == 1
    assert got.count((None, "x y z")) == got.count((4, "")) == got.count((None, None)) == 1
    assert got.count((None, "")) == 2 and len(got) == 7
