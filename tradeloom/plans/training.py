"""From archived trades to a model version that awaits approval."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession

from tradeloom.config import Settings
from tradeloom.operators.evaluation import ModelRegistry, report
from tradeloom.operators.features import feature_recent, feature_windows, split_by_time
from tradeloom.operators.iforest import IsolationForest, IsolationForestModel, score_signals
from tradeloom.schemas import FEATURE_COLS
from tradeloom.sources.medallion import lookback_bronze, read_feature_csv, with_arrival, write_feature_csv
from tradeloom.storage import Stage


def build_features(
    spark: SparkSession, bronze: str, out: str, now: datetime, cfg: Settings, lookback_days: int = 14, validation_days: int = 2
) -> None:
    """Features of the archive's last days as CSV, split by time into training and validation rows."""
    trades = with_arrival(lookback_bronze(spark, bronze, now, lookback_days, arrival=True))
    rows = split_by_time(feature_windows(trades, cfg.feature_bucket_ms), now, validation_days)
    write_feature_csv(rows.select("symbol", "event_time", *FEATURE_COLS, "split"), out)


def train(spark: SparkSession, features: str, model_path: str, **params) -> IsolationForestModel:
    """Fit on the training rows and save; ``params`` go to the estimator."""
    model = IsolationForest(**params).fit(read_feature_csv(spark, features, "train"))
    model.save(spark, model_path)
    return model


def score(spark: SparkSession, model_path: str, rows: DataFrame) -> DataFrame:
    """Score feature rows with a saved model."""
    return IsolationForestModel.load(spark, model_path).transform(rows)


def evaluate(spark: SparkSession, model_path: str, features: str, report_path: str) -> Row:
    """Score the validation rows and write the report as JSON."""
    scored = score(spark, model_path, read_feature_csv(spark, features, "validation")).select("symbol", "score").persist()
    try:
        row = report(scored)
        row.coalesce(1).write.mode("overwrite").json(report_path)
    finally:
        scored.unpersist()
    return spark.read.schema(row.schema).json(report_path).first()


def run(spark: SparkSession, bronze: str, work: str, registry: ModelRegistry, now: datetime, cfg: Settings, **params) -> int | None:
    """All steps; the new version number, or None when the anomaly rate is outside the accepted band."""
    build_features(spark, bronze, f"{work}/features", now, cfg)
    train(spark, f"{work}/features", f"{work}/model", **params)
    result = evaluate(spark, f"{work}/model", f"{work}/features", f"{work}/report")
    return registry.register(f"{work}/model", result["anomaly_rate"], now)


def approved_score(registry: ModelRegistry, trades: DataFrame, cfg: Settings, stage: Stage) -> Callable[[DataFrame], DataFrame]:
    """How a ``plans.gold.Pipeline`` scores its signals with the newest approved model: each by its symbol's latest trades.

    Without an approved model the scores are null. The signals are stored first, as the features read them several times.
    """
    row = registry.approved().first()
    model = row and IsolationForestModel.load(row["path"])

    def score(signals: DataFrame) -> DataFrame:
        if model is None:
            return score_signals(signals, signals, None)
        kept = stage.table(f"to-score/{signals.semanticHash()}", lambda: signals)
        return score_signals(kept, feature_recent(trades, cfg.recent_trades, cfg.volume_window_ms, kept), model)

    return score
