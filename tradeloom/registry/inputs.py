"""The driver's ``events`` table read as a trade feed.

Event types stand for symbols, ``value`` for the volume, and a price is derived from the ``k`` property.
The feed is sparse, so every market duration is stretched a hundredfold.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.config import Settings
from tradeloom.functions.columns import ts_literal
from tradeloom.plans.gold import Pipeline

CFG = Settings(symbols=("click", "error", "purchase", "signup", "view")).scaled(100)
AS_OF = datetime(2024, 1, 30, 23, 59, 59)
DAY = date(2024, 1, 18)

_pipelines: dict[tuple[str, ...], Pipeline] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def price() -> Column:
    return F.lit(100.0) + F.pow(F.get_json_object("props", "$.k").cast("int"), F.lit(4)) / F.lit(1e6)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir).select(
            F.col("event_type").alias("s"),
            price().alias("p"),
            F.col("value").alias("v"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("t"),
            F.col("event_id").alias("seq"),
        )
    )


def stand_in_score(signals: DataFrame) -> DataFrame:
    """A fixed score per signal, so that reports can be compared; the forest has its own queries."""
    return signals.withColumn(
        "ml_anomaly_score", F.when(F.col("seq") % 10 != 0, F.col("trade_ts") % 1000 / F.lit(1000.0))
    )


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Pipeline]) -> Pipeline:
    """A pipeline and its stage tables, made once per application."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _pipelines:
        _pipelines[key] = build()
    return _pipelines[key]


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    def build() -> Pipeline:
        return Pipeline(spark, trades(spark, sf_dir), f"events:{sf_dir}", CFG, stand_in_score, ts_literal(AS_OF))

    return once(spark, sf_dir, "events", build)
