"""Data and plain counterparts that several tests share."""

import os

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TEXT = "doc_id bigint, text string"


def texts(spark, rows):
    """A table of documents with columns that operators must not trip over."""
    data = [(i, t, "en", 1, "x") for i, t in rows]
    return spark.createDataFrame(data, f"{TEXT}, lang string, v int, n_words string")


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def ordered(rows):
    """Rows in an order that nulls don't upset."""
    return sorted(rows, key=lambda r: [(x is None, x if x is not None else 0) for x in r])
