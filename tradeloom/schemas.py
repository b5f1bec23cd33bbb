"""Explicit schemas of every layer; nothing is inferred."""

from __future__ import annotations

# Field names and types of every record.
TRADE = "s string, p double, v double, t bigint"
FRAME = "type string, data array<struct<s:string,p:double,v:double,t:bigint,c:array<string>>>"
ENVELOPE = "kinesis struct<data:string>"

SNAPSHOT_ENTRY = (
    "symbol string, last_price double, open_price double, pct_change double, "
    "trade_count int, total_volume double, last_trade_ts bigint, is_stale boolean"
)

VOLUME_SPIKE = (
    "signal_type string, symbol string, price double, trade_volume double, avg_volume double, "
    "spike_ratio double, window_trade_count int, window_span_secs double, trade_ts bigint, "
    "detected_at string, ml_anomaly_score double"
)
MOMENTUM_SIGNAL = (
    "signal_type string, symbol string, direction string, candles_in_direction int, total_candles int, "
    "oldest_open double, latest_close double, pct_change double, window_start_ts bigint, "
    "window_end_ts bigint, detected_at string, ml_anomaly_score double"
)
VOLATILITY_SPIKE = (
    "signal_type string, symbol string, price double, mean_price double, std_dev double, z_score double, "
    "window_trade_count int, window_span_secs double, trade_ts bigint, detected_at string, "
    "ml_anomaly_score double"
)
SECTOR_SNAPSHOT = (
    "signal_type string, snapshot_ts string, symbols array<struct<"
    + ",".join(c.strip().replace(" ", ":", 1) for c in SNAPSHOT_ENTRY.split(","))
    + ">>"
)

PAYLOADS = {
    "volume_spike": VOLUME_SPIKE,
    "momentum_signal": MOMENTUM_SIGNAL,
    "volatility_spike": VOLATILITY_SPIKE,
    "sector_snapshot": SECTOR_SNAPSHOT,
}

# One wide nullable record that holds any signal; used on the wire and by the stream processors.
UNIFIED_SIGNAL = (
    "signal_type string, symbol string, price double, trade_volume double, avg_volume double, "
    "spike_ratio double, mean_price double, std_dev double, z_score double, window_trade_count int, "
    "window_span_secs double, direction string, candles_in_direction int, total_candles int, "
    "oldest_open double, latest_close double, pct_change double, window_start_ts bigint, "
    "window_end_ts bigint, trade_ts bigint, detected_at string, ml_anomaly_score double, "
    "snapshot_ts string, symbols array<struct<"
    + ",".join(c.strip().replace(" ", ":", 1) for c in SNAPSHOT_ENTRY.split(","))
    + ">>"
)

GOLD_VOLUME = (
    "timestamp timestamp, detected_at timestamp, processed_at timestamp, symbol string, price double, "
    "trade_volume double, avg_volume double, spike_ratio double, window_trade_count int, "
    "window_span_secs double, ml_anomaly_score double"
)
GOLD_MOMENTUM = (
    "window_end_ts timestamp, window_start_ts timestamp, detected_at timestamp, processed_at timestamp, "
    "symbol string, direction string, candles_in_direction int, total_candles int, oldest_open double, "
    "latest_close double, pct_change double, ml_anomaly_score double"
)
GOLD_VOLATILITY = (
    "timestamp timestamp, detected_at timestamp, processed_at timestamp, symbol string, price double, "
    "mean_price double, std_dev double, z_score double, window_trade_count int, window_span_secs double, "
    "ml_anomaly_score double"
)
GOLD_SECTOR = (
    "snapshot_ts timestamp, processed_at timestamp, symbol string, last_price double, open_price double, "
    "pct_change double, trade_count int, total_volume double, last_trade_ts timestamp, is_stale boolean"
)

# table -> (schema, time column that with `symbol` is the key, time column that reports filter on).
# The physical `date` partition column is the day of the latter.
GOLD_TABLES = {
    "volume_spikes": (GOLD_VOLUME, "detected_at", "detected_at"),
    "momentum_signals": (GOLD_MOMENTUM, "window_end_ts", "detected_at"),
    "volatility_spikes": (GOLD_VOLATILITY, "detected_at", "detected_at"),
    "sector_snapshots": (GOLD_SECTOR, "snapshot_ts", "snapshot_ts"),
}

SIGNAL_TABLE = {
    "volume_spike": "volume_spikes",
    "momentum_signal": "momentum_signals",
    "volatility_spike": "volatility_spikes",
    "sector_snapshot": "sector_snapshots",
}

FEATURE_COLS = (
    "batch_trade_count",
    "price_mean",
    "price_std",
    "price_min",
    "price_max",
    "volume_sum",
    "volume_mean",
    "volume_max",
    "price_change_pct",
)
FEATURES = "symbol string, event_time string, " + ", ".join(f"{c} double" for c in FEATURE_COLS)


def column_names(ddl: str) -> list[str]:
    """Top-level column names of one of the DDL strings above."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).names
