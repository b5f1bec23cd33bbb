"""From raw documents to packed training sequences: each stage works on all that the one before kept.

Every stage but the last returns the columns of ``documents``; ``n_chars`` follows a changed text. Rows with a null text or
``doc_id`` pass through all stages, each of which defines what it does with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import minhash, packing, pii, recompress, toxicity
from tradeloom.llm.common import documents, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted to the labelled ones among them, finds likelier toxic than clean go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.Model.fit(docs, toxicity.grades(labels)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one row stays: the one of least ``doc_id`` (null is largest) and text hash.

    Texts that aren't near duplicates stay, even under one id. Of repeated rows without words one stays, or all if
    they have no id.
    """
    found = minhash.with_components(docs).groupBy("doc_id", "text_hash", "component").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct(F.coalesce("doc_id", F.lit(minhash.NO_ID)).alias("least"), "text_hash", "doc_id", "n"))
    one = found.filter("component is not null").groupBy("component").agg(least.alias("x"))
    bare = found.filter("component is null").select("doc_id", "text_hash", F.expr("if(doc_id is null, 1, n)").alias("n"))
    stay = stage(one.select("x.doc_id", "x.text_hash", "x.n").union(bare), "kept-documents")
    rows = _keyed(docs).join(_as_key(stay, "n"), "key")
    # Texts of repeated rows alone are dealt out again.
    first = F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")
    again = rows.filter("n > 1").groupBy("key").agg(first).select("row.*")
    return rows.filter("n = 1").select("row.*").union(again)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; a document that held nothing else stays with an empty text."""
    found = recompress.remove_repeats(docs).filter("n_removed > 0").dropDuplicates(["doc_id", "text_hash"])
    rows = _keyed(docs).join(_as_key(found, "kept_text"), "key", "left")
    return _with_text(rows, F.coalesce("kept_text", F.col("row")["text"]), docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind in brackets."""
    return _with_text(pii.mask(docs).select(F.struct("*").alias("row")), F.col("row")["text"], docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens, with their ids."""
    return packing.pack(docs)


def _keyed(docs: DataFrame) -> DataFrame:
    """Whole rows beside what tells them apart, so that no column's name can clash with another."""
    key = F.struct(F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text").cast("string")))
    return docs.select(F.struct("*").alias("row"), _text_of(key).alias("key"))


def _as_key(found: DataFrame, *more: str) -> DataFrame:
    return found.select(_text_of(F.struct("doc_id", "text_hash")).alias("key"), *more)


def _text_of(key: Column) -> Column:
    """A key that equals itself where the id is null."""
    return F.to_json(key.cast("struct<a:bigint,b:bigint>"))


def _with_text(rows: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return rows.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in columns])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", drop_repeats),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: Several stages fit a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
