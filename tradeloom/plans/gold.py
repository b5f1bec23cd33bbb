"""From trades to the four gold tables, through small stage tables written once."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.config import Settings
from tradeloom.functions.columns import ms_to_ts
from tradeloom.operators import detectors as d
from tradeloom.operators import sessions
from tradeloom.schemas import GOLD_TABLES, column_names
from tradeloom.storage import Stage


def no_score(signals: DataFrame) -> DataFrame:
    return signals.withColumn("ml_anomaly_score", F.lit(None).cast("double"))


def gold_volume(signals: DataFrame, processed_at: Column) -> DataFrame:
    return _finish(
        signals.withColumn("timestamp", ms_to_ts(F.col("trade_ts"))).withColumn("detected_at", F.col("timestamp")),
        "volume_spikes",
        processed_at,
    )


def gold_momentum(signals: DataFrame, processed_at: Column) -> DataFrame:
    return _finish(
        signals.withColumn("detected_at", ms_to_ts(F.col("trade_ts")))
        .withColumn("window_start_ts", ms_to_ts(F.col("window_start_ts")))
        .withColumn("window_end_ts", ms_to_ts(F.col("window_end_ts"))),
        "momentum_signals",
        processed_at,
    )


def gold_volatility(signals: DataFrame, processed_at: Column) -> DataFrame:
    return _finish(
        signals.withColumn("timestamp", ms_to_ts(F.col("trade_ts"))).withColumn("detected_at", F.col("timestamp")),
        "volatility_spikes",
        processed_at,
    )


def gold_sector(snapshots: DataFrame, processed_at: Column) -> DataFrame:
    return _finish(
        snapshots.withColumn("snapshot_ts", ms_to_ts(F.col("snapshot_ms"))).withColumn(
            "last_trade_ts", ms_to_ts(F.col("last_trade_ts"))
        ),
        "sector_snapshots",
        processed_at,
    )


def _finish(rows: DataFrame, table: str, processed_at: Column) -> DataFrame:
    ddl, _, report_time = GOLD_TABLES[table]
    return (
        rows.withColumn("processed_at", processed_at)
        .select(*column_names(ddl))
        .withColumn("date", F.to_date(report_time))
    )


def laid_out(gold: DataFrame, table: str) -> DataFrame:
    """Rows dealt into ranges of day, symbol and time and ordered by them, so files prune by each, and a day or a symbol
    that holds most rows is spread over tasks."""
    order = ("date", "symbol", GOLD_TABLES[table][2])
    return gold.repartitionByRange(*order).sortWithinPartitions(*order)


class Pipeline:
    """Lazily built stage tables of one trade set.

    The trades are read for the sliding windows, the candles and the ticks. Each of those results is far smaller
    than the trades and is written to the shared folder; everything after it, cooldowns, snapshots and gold
    included, reads that.
    """

    def __init__(
        self,
        spark: SparkSession,
        trades: DataFrame,
        name: str,
        cfg: Settings,
        score: Callable[[DataFrame], DataFrame] = no_score,
        processed_at: Column | None = None,
    ):
        self.spark, self.trades, self.cfg, self.score = spark, trades, cfg, score
        self.processed_at = F.current_timestamp() if processed_at is None else processed_at
        self.stage = Stage(spark, f"{name} {cfg!r} {trades.semanticHash()}")

    # stage tables

    @cached_property
    def spike_rows(self) -> DataFrame:
        return self.stage.table("spike_rows", lambda: d.spike_rows(self.trades, self.cfg))

    @cached_property
    def bars(self) -> DataFrame:
        return self.stage.table("bars", lambda: d.candles(self.trades, self.cfg.candle_ms))

    @cached_property
    def ticks(self) -> DataFrame:
        return self.stage.table("ticks", lambda: d.tick_states(self.trades, self.cfg.snapshot_ms))

    @cached_property
    def momentum_rows(self) -> DataFrame:
        return self.stage.table("momentum_rows", lambda: d.momentum_candidates(self.completed(), self.cfg))

    # detectors over stage tables

    def completed(self) -> DataFrame:
        return d.completed_candles(self.bars)

    def volume(self) -> DataFrame:
        return d.volume_spikes(d.volume_fields(self.spike_rows.filter("is_volume")), self.cfg)

    def volatility(self) -> DataFrame:
        return d.volatility_spikes(d.volatility_fields(self.spike_rows.filter("is_volatility")), self.cfg)

    def momentum(self) -> DataFrame:
        return d.momentum_signals(self.momentum_rows, self.cfg)

    def snapshots(self) -> DataFrame:
        return d.sector_snapshots(self.ticks, d.symbol_table(self.spark, self.cfg.symbols), self.cfg)

    # gold

    def gold_rows(self, table: str) -> DataFrame:
        if table == "volume_spikes":
            return gold_volume(self.score(self.volume()), self.processed_at)
        if table == "momentum_signals":
            return gold_momentum(self.score(self.momentum()), self.processed_at)
        if table == "volatility_spikes":
            return gold_volatility(self.score(self.volatility()), self.processed_at)
        return gold_sector(self.snapshots(), self.processed_at)

    def gold(self, table: str) -> DataFrame:
        return self.stage.table(f"gold/{table}", lambda: laid_out(self.gold_rows(table), table), ("date",))

    @property
    def volume_spikes(self) -> DataFrame:
        return self.gold("volume_spikes")

    @property
    def momentum_signals(self) -> DataFrame:
        return self.gold("momentum_signals")

    @property
    def volatility_spikes(self) -> DataFrame:
        return self.gold("volatility_spikes")

    @property
    def sector_snapshots(self) -> DataFrame:
        return self.gold("sector_snapshots")


class SessionPipeline(Pipeline):
    """The same for a feed with silences: detectors, features and snapshots start anew after each that is longer than ``gap_ms``.

    The trades are stored once with their session, which stands in for the symbol in the tables that it builds.
    """

    def __init__(self, spark: SparkSession, trades: DataFrame, name: str, cfg: Settings, gap_ms: int):
        super().__init__(spark, trades, f"{name} apart {gap_ms}", cfg)
        self.gap_ms = gap_ms
        self.trades = self.stage.table("trades", lambda: d.apart(trades, gap_ms))

    @cached_property
    def signals(self) -> DataFrame:
        """The signals of the three detectors, with ``session_id``."""
        found = d.unify(self.volume(), self.momentum(), self.volatility())
        return self.stage.table("signals", lambda: d.session_shown(found))

    def features(self) -> DataFrame:
        """The features to score each signal by."""
        return sessions.features_in_sessions(self.trades, self.cfg, self.signals)

    def snapshots(self) -> DataFrame:
        return sessions.snapshots_in_sessions(self.ticks, d.symbol_table(self.spark, self.cfg.symbols), self.cfg, self.gap_ms)
