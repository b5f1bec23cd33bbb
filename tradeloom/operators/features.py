"""The nine-number description of a group of trades, over time buckets, recent trades or batches."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import arrival_order, bucket, ms_to_iso_seconds, pct_change, ts_literal
from tradeloom.operators.blocks import numbered, running
from tradeloom.operators.skew import time_blocks
from tradeloom.operators.sliding import sliding_stats


def feature_vector(trades: DataFrame, by: Sequence[str | Column], arrival: Column | None = None) -> DataFrame:
    """Features per group; partial aggregation reduces a group of any size before the shuffle.

    ``arrival`` orders the trades of a group and is ``(t, seq)`` unless given.
    """
    arrival = F.struct("t", "seq") if arrival is None else arrival
    grouped = trades.groupBy(*by).agg(
        F.max("t").alias("max_t"),
        F.count(F.lit(1)).cast("double").alias("batch_trade_count"),
        F.avg("p").alias("price_mean"),
        F.stddev_pop("p").alias("price_std"),
        F.min("p").alias("price_min"),
        F.max("p").alias("price_max"),
        F.sum("v").alias("volume_sum"),
        F.avg("v").alias("volume_mean"),
        F.max("v").alias("volume_max"),
        F.min_by("p", arrival).alias("_first"),
        F.max_by("p", arrival).alias("_last"),
    )
    return (
        grouped.withColumn("price_change_pct", pct_change(F.col("_first"), F.col("_last")))
        .withColumn("event_time", ms_to_iso_seconds(F.col("max_t")))
        .drop("_first", "_last")
    )


def feature_windows(trades: DataFrame, bucket_ms: int) -> DataFrame:
    """Features per (symbol, time bucket)."""
    arrival = arrival_order(F.pmod("t", F.lit(bucket_ms)), F.col("seq"), bucket_ms)
    return feature_vector(trades, [F.col("s").alias("symbol"), bucket("t", bucket_ms).alias("bucket")], arrival)


def feature_batches(trades: DataFrame, batch: str) -> DataFrame:
    """Features per (symbol, batch of arriving trades)."""
    return feature_vector(trades, [F.col("s").alias("symbol"), batch])


def feature_recent(trades: DataFrame, recent: int, block_ms: int, at: DataFrame | None = None) -> DataFrame:
    """Features of the latest ``recent`` trades of its symbol, for every trade or for those listed in ``at``.

    Trades are numbered per symbol block by block; the numbers then serve as the axis of the sliding window,
    so a symbol is spread over many tasks although the window counts rows and not time. ``at`` has the columns
    ``symbol, trade_ts, seq`` and should be a stored table, as it is read several times; with it, trades that
    no listed one looks back on are dropped right after the numbering.
    """
    if at is None:
        blocked = time_blocks(trades, ["s"], "t", "seq", block_ms)
        ranked = numbered(blocked, ["s"], "_block", ["t", "seq"]).drop("_block")
    else:
        at = at.select(F.col("symbol").alias("s"), F.col("trade_ts").alias("t"), "seq").distinct()
        ranked = _looked_back_on(trades, at, recent, block_ms)
    place = F.struct("rn", "p")
    slid = sliding_stats(
        ranked,
        ["s"],
        "rn",
        "seq",
        recent - 1,
        1,
        {
            "n": ("sum", F.lit(1).cast("bigint")),
            "price_min": ("min", F.col("p")),
            "price_max": ("max", F.col("p")),
            "volume_sum": ("sum", F.col("v")),
            "volume_max": ("max", F.col("v")),
            "oldest": ("min", place),
        },
        {"price": "p"},
    )
    if at is not None:
        slid = slid.join(at, ["s", "t", "seq"], "left_semi")
    return slid.select(
        F.col("s").alias("symbol"),
        "t",
        "seq",
        F.col("n").cast("double").alias("batch_trade_count"),
        "price_mean",
        F.when(F.col("price_min") < F.col("price_max"), F.sqrt("price_var")).otherwise(F.lit(0.0)).alias("price_std"),
        "price_min",
        "price_max",
        "volume_sum",
        (F.col("volume_sum") / F.col("n")).alias("volume_mean"),
        "volume_max",
        pct_change(F.col("oldest.p"), F.col("p")).alias("price_change_pct"),
    )


def _looked_back_on(trades: DataFrame, at: DataFrame, recent: int, block_ms: int) -> DataFrame:
    """Numbered trades that are among the latest ``recent`` of some trade in ``at``, and a few more.

    The listed trades enter as marks right behind themselves. A trade stays if the next mark of its block is
    near enough, or if it is so late in its block that a mark of a later block may look back on it.
    """
    order = ["t", "seq", "_mark"]
    marked = trades.withColumn("_mark", F.lit(0)).unionByName(at.withColumn("_mark", F.lit(1)), True)
    blocked = time_blocks(marked, ["s"], "t", "seq", block_ms)
    ranked = running(blocked, ["s"], "_block", order, {"rn": ("count", "p")})
    from_end = (
        Window.partitionBy("s", "_block")
        .orderBy(*[F.desc(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    next_mark = F.last(F.when(F.col("_mark") == 1, F.col("rn")), ignorenulls=True).over(from_end)
    seen = ranked.withColumn("_next", next_mark).withColumn("_left", F.count("p").over(from_end))
    needed = (F.col("_next") - F.col("rn") < recent) | (F.col("_left") < recent)
    return seen.filter((F.col("_mark") == 0) & needed).drop("_mark", "_block", "_next", "_left")


def split_by_time(features: DataFrame, now: datetime, validation_days: int = 2) -> DataFrame:
    """Rows whose last trade lies in the final days validate, the rest train."""
    cutoff = ts_literal(now - timedelta(days=validation_days))
    late = F.col("max_t") >= F.unix_millis(cutoff)
    return features.withColumn("split", F.when(late, "validation").otherwise("train"))


