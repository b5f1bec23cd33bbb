"""Finding groups that are too large for one task, so that they can be split."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import bucket
from tradeloom.storage import shared_root

# A group above this many rows is split.
HOT_ROWS = 5_000_000


def hot_groups(rows: DataFrame, by: Sequence[str | Column], more_than: int, *aggregates: Column) -> DataFrame | None:
    """The groups with more than ``more_than`` rows, with aggregates of each; None when there are none.

    Runs one counting job, reduced before its shuffle. All of them are written to the shared folder, so the list may
    be of any length; join it without a hint.
    """
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    hot = counts.filter(F.col("_rows") > more_than)
    path = f"{shared_root(rows.sparkSession)}/hot-{uuid.uuid4().hex}"
    hot.write.parquet(path)
    found = rows.sparkSession.read.schema(hot.schema).parquet(path)
    return None if found.isEmpty() else found


def load(rows: DataFrame, by: Sequence[str | Column]) -> tuple[float, int]:
    """Mean and greatest number of rows per group, from one counting job reduced before its shuffle."""
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(F.avg("n").alias("mean"), F.max("n").alias("most")).first()
    return found["mean"] or 0.0, found["most"] or 0


def time_blocks(
    rows: DataFrame, keys: Sequence[str], t: str, tie: str, block_ms: int, hot_rows: int = HOT_ROWS, name: str = "_block"
) -> DataFrame:
    """Add an ordered block of ``block_ms`` per row; the blocks of a key in which too many rows fall are
    divided further, down to one time and ``hot_rows`` arrivals."""
    start = bucket(t, block_ms) * block_ms
    whole = F.struct(start.alias("at"), F.lit(0).cast("bigint").alias("part"))
    hot = hot_groups(rows, [*keys, start.alias("_start")], hot_rows)
    if hot is None:
        return rows.withColumn(name, whole)
    fine = F.struct(F.col(t).alias("at"), bucket(tie, hot_rows).alias("part"))
    marked = rows.withColumn("_start", start).join(hot, [*keys, "_start"], "left")
    return marked.withColumn(name, F.when(F.col("_rows").isNotNull(), fine).otherwise(whole)).drop("_start", "_rows")
