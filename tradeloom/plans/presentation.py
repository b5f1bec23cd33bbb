"""What a screen derives from the reports: verdicts, scores, colours, top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import signal_score, two_places_or_na
from tradeloom.functions.percentiles import exact_percentiles


def symbol_filter(rows: DataFrame, symbols: Sequence[str], column: str = "symbol") -> DataFrame:
    """Keep the chosen symbols; an empty choice keeps all."""
    return rows.filter(F.col(column).isin(*symbols)) if symbols else rows


def breadth_verdict(breadth: DataFrame) -> DataFrame:
    up, down = F.count_if(F.col("pct_change") > 0), F.count_if(F.col("pct_change") < 0)
    counts = breadth.agg(up.alias("up"), down.alias("down"), F.count(F.lit(1)).alias("n"))
    verdict = (
        F.when(F.col("up") > F.col("down") + 2, "BULLISH").when(F.col("down") > F.col("up") + 2, "BEARISH").otherwise("MIXED")
    )
    return counts.select("up", "down", (F.col("n") - F.col("up") - F.col("down")).alias("flat"), verdict.alias("verdict"))


def with_score(live: DataFrame) -> DataFrame:
    return live.withColumn("score", signal_score(F.col("signal_type"), F.col("strength")))


def top_active(live: DataFrame, top: int = 5) -> DataFrame:
    """Highest scores, the newest first among equals, with the score text shown beside them."""
    return (
        with_score(live)
        .withColumn("ml_text", two_places_or_na(F.col("ml_anomaly_score")))
        .orderBy(F.desc("score"), F.desc("detected_at"), "symbol", "signal_type")
        .limit(top)
    )


def signal_mix(live: DataFrame) -> DataFrame:
    return live.groupBy("signal_type").agg(F.count(F.lit(1)).alias("n"))


def ml_confirmed_live(live: DataFrame, least: float) -> DataFrame:
    return live.filter(F.coalesce("ml_anomaly_score", F.lit(0.0)) >= least)


def orb_breakouts(opening: DataFrame) -> DataFrame:
    return opening.filter(F.col("orb_status") != "IN_RANGE")


def rvol_colored(rvol: DataFrame) -> DataFrame:
    color = F.when(F.col("rvol") >= 1.5, "green").when(F.col("rvol") >= 1.0, "orange").otherwise("red")
    return rvol.withColumn("color", color)


def top_pairs(pairs: DataFrame, top: int = 10) -> DataFrame:
    return (
        pairs.orderBy(F.desc("co_signal_count"), "symbol_a", "symbol_b")
        .limit(top)
        .select(F.concat_ws("/", "symbol_a", "symbol_b").alias("pair"), "co_signal_count")
    )


def score_percentiles(distribution: DataFrame) -> DataFrame:
    return exact_percentiles(distribution, "ml_anomaly_score", {"p50": 0.5, "p90": 0.9})


def score_histogram(distribution: DataFrame, bins: int = 20) -> DataFrame:
    """Counts per kind and bin of [0, 1]; a score of exactly 1 belongs to the last bin."""
    bin_no = F.least(F.lit(bins), F.width_bucket("ml_anomaly_score", F.lit(0.0), F.lit(1.0), F.lit(bins)))
    return distribution.groupBy("signal_type", bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
