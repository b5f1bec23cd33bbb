"""Settings of the detectors, features and reports. All durations are milliseconds."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

# The default symbol domain.
SYMBOLS = ("AAPL", "AMD", "AMZN", "AVGO", "GOOGL", "META", "MSFT", "NVDA", "PLTR", "TSLA")

# The four signal kinds and the archive prefix of each.
SIGNAL_PREFIX = {
    "volume_spike": "volume",
    "momentum_signal": "momentum",
    "volatility_spike": "volatility",
    "sector_snapshot": "sector",
}

DAY_MS = 86_400_000


@dataclass(frozen=True)
class Settings:
    symbols: tuple[str, ...] = SYMBOLS

    # The defaults of the detectors, features and reports.
    volume_window_ms: int = 300_000
    volume_min_span_ms: int = 60_000
    volume_multiplier: float = 4.0
    volume_cooldown_ms: int = 180_000

    volatility_window_ms: int = 300_000
    volatility_min_span_ms: int = 60_000
    volatility_z: float = 2.5
    volatility_cooldown_ms: int = 120_000

    candle_ms: int = 60_000
    momentum_candles: int = 5
    momentum_min_agree: int = 3
    momentum_cooldown_ms: int = 120_000

    snapshot_ms: int = 60_000
    stale_ms: int = 120_000

    feature_bucket_ms: int = 300_000
    cluster_ms: int = 120_000
    cluster_lookback_ms: int = 3_600_000
    live_lookback_ms: int = 600_000
    exit_from_ms: int = 900_000
    exit_to_ms: int = 1_800_000
    pnl_5_from_ms: int = 240_000
    pnl_5_to_ms: int = 360_000
    pnl_15_from_ms: int = 840_000
    pnl_15_to_ms: int = 960_000
    pnl_30_from_ms: int = 1_740_000
    pnl_30_to_ms: int = 1_860_000
    confirm_ms: int = 300_000
    pair_ms: int = 600_000

    # Not scaled by `scaled`: clock times, counts, rates and physical layout.
    ingest_staleness: int = 60_000
    session_open: str = "09:30:00"
    opening_range_minutes: int = 30
    recent_trades: int = 100
    min_cluster_symbols: int = 3
    ml_confirmed: float = 0.75
    window_parts: int = 0  # slices per sliding window; 0 chooses by the density of the feed

    def scaled(self, factor: int) -> Settings:
        """The same settings with every market duration multiplied, for sparse feeds."""
        return replace(
            self, **{f.name: getattr(self, f.name) * factor for f in fields(self) if f.name.endswith("_ms")}
        )

    @property
    def warm_start_ms(self) -> int:
        return max(self.volume_window_ms, self.volatility_window_ms)
