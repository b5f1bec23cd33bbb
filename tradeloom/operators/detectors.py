"""Volume, volatility, momentum and sector detectors over trades ``(s, p, v, t, seq)``.

``t`` is epoch milliseconds and ``seq`` the arrival order, which settles equal times. Every detector has a
``*_candidates`` step (all rows that meet its condition) and a thinned step that applies the cooldown.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.config import DAY_MS, Settings
from tradeloom.functions.columns import arrival_order, bucket, half_even, ms_to_iso, ms_to_ts
from tradeloom.operators.blocks import next_value, numbered, running, with_preceding
from tradeloom.operators.cooldown import cooldown_thin
from tradeloom.operators.skew import HOT_ROWS, load, time_blocks
from tradeloom.operators.sliding import sliding_stats

# Slices per window, and the mean rows of a coarse slice from which fine ones pay.
COARSE, FINE, DENSE_ROWS = 10, 60, 3000

# A value worked out from sums of doubles may miss a threshold that the exact one meets by this share of it. The share
# is far above the rounding errors of any order of addition, so a trade at the threshold fires whatever the layout.
MEAN_NOISE, SPREAD_NOISE = 1e-11, 1e-9

# ---- rolling window (D1, D2) ----------------------------------------------------------------------


def rolling_stats(
    trades: DataFrame, window_ms: int, parts: int = 0, session: tuple[str, ...] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Each trade with its trailing window, itself included: count, earliest time, volume sum, price moments.

    Counts the trades per slice first. A dense feed gets finer slices, which a window then holds in memory; a
    sparse one coarser slices, since each is copied ``parts - 1`` times. Too large slices are split.
    """
    mean, most = load(trades, ["s", *session, bucket("t", max(window_ms // COARSE, 1)).alias("slice")])
    if not parts:
        wanted = FINE if mean >= DENSE_ROWS else COARSE
        parts = next(n for n in (wanted, COARSE, 6, 5, 4, 3, 2, 1) if window_ms % n == 0)
    return sliding_stats(
        trades,
        ["s", *session],
        "t",
        "seq",
        window_ms,
        parts,
        {
            "w_count": ("sum", F.lit(1).cast("bigint")),
            "w_from": ("min", F.col("t")),
            "w_volume": ("sum", F.col("v")),
            "w_low": ("min", F.col("p")),
            "w_high": ("max", F.col("p")),
        },
        {"w_price": "p"},
        hot_rows if most > hot_rows else None,
    )


def _open_long_enough(min_span_ms: int) -> Column:
    return (F.col("w_count") >= 2) & (F.col("t") - F.col("w_from") >= min_span_ms)


def _span_secs() -> Column:
    return half_even((F.col("t") - F.col("w_from")) / 1000.0, 1)


# ---- volume spike (D3) ----------------------------------------------------------------------------


def prior_mean_volume() -> Column:
    return F.try_divide(F.col("w_volume") - F.col("v"), F.col("w_count") - 1)


def is_volume_spike(cfg: Settings) -> Column:
    mean = F.when(_open_long_enough(cfg.volume_min_span_ms), prior_mean_volume())
    return F.coalesce((mean > 0) & (F.col("v") >= mean * cfg.volume_multiplier * (1 - MEAN_NOISE)), F.lit(False))


def volume_fields(rolled: DataFrame, *extra: str) -> DataFrame:
    mean = prior_mean_volume()
    return rolled.select(
        F.col("s").alias("symbol"),
        *extra,
        F.col("p").alias("price"),
        F.col("v").alias("trade_volume"),
        half_even(mean, 2).alias("avg_volume"),
        half_even(F.col("v") / mean, 2).alias("spike_ratio"),
        F.col("w_count").cast("int").alias("window_trade_count"),
        _span_secs().alias("window_span_secs"),
        F.col("t").alias("trade_ts"),
        "seq",
    )


def volume_candidates(trades: DataFrame, cfg: Settings, session: tuple[str, ...] = ()) -> DataFrame:
    rolled = rolling_stats(trades, cfg.volume_window_ms, cfg.window_parts, session)
    return volume_fields(rolled.filter(is_volume_spike(cfg)), *session)


def volume_spikes(candidates: DataFrame, cfg: Settings, session: tuple[str, ...] = ()) -> DataFrame:
    return cooldown_thin(candidates, ["symbol", *session], "trade_ts", "seq", cfg.volume_cooldown_ms)


# ---- volatility spike (D4) ------------------------------------------------------------------------


def z_score() -> Column:
    # Equal prices are recognised exactly, not by a variance that came out as zero.
    return F.when(
        (F.col("w_low") < F.col("w_high")) & (F.col("w_price_var") > 0),
        F.abs(F.col("p") - F.col("w_price_mean")) / F.sqrt("w_price_var"),
    )


def is_volatility_spike(cfg: Settings) -> Column:
    z = F.when(_open_long_enough(cfg.volatility_min_span_ms), z_score())
    return F.coalesce(z >= cfg.volatility_z * (1 - SPREAD_NOISE), F.lit(False))


def volatility_fields(rolled: DataFrame, *extra: str) -> DataFrame:
    return rolled.select(
        F.col("s").alias("symbol"),
        *extra,
        F.col("p").alias("price"),
        half_even(F.col("w_price_mean"), 4).alias("mean_price"),
        half_even(F.sqrt("w_price_var"), 4).alias("std_dev"),
        half_even(z_score(), 3).alias("z_score"),
        F.col("w_count").cast("int").alias("window_trade_count"),
        _span_secs().alias("window_span_secs"),
        F.col("t").alias("trade_ts"),
        "seq",
    )


def volatility_candidates(trades: DataFrame, cfg: Settings, session: tuple[str, ...] = ()) -> DataFrame:
    rolled = rolling_stats(trades, cfg.volatility_window_ms, cfg.window_parts, session)
    return volatility_fields(rolled.filter(is_volatility_spike(cfg)), *session)


def volatility_spikes(candidates: DataFrame, cfg: Settings, session: tuple[str, ...] = ()) -> DataFrame:
    return cooldown_thin(candidates, ["symbol", *session], "trade_ts", "seq", cfg.volatility_cooldown_ms)


def spike_rows(trades: DataFrame, cfg: Settings) -> DataFrame:
    """Both window detectors in one pass over the trades: flagged rows with their window statistics."""
    if cfg.volume_window_ms == cfg.volatility_window_ms:
        rolled = rolling_stats(trades, cfg.volume_window_ms, cfg.window_parts)
        flagged = rolled.withColumn("is_volume", is_volume_spike(cfg)).withColumn(
            "is_volatility", is_volatility_spike(cfg)
        )
        return flagged.filter(F.col("is_volume") | F.col("is_volatility"))
    volume = rolling_stats(trades, cfg.volume_window_ms, cfg.window_parts).filter(is_volume_spike(cfg))
    volatility = rolling_stats(trades, cfg.volatility_window_ms, cfg.window_parts).filter(is_volatility_spike(cfg))
    return (
        volume.withColumn("is_volume", F.lit(True))
        .withColumn("is_volatility", F.lit(False))
        .unionByName(volatility.withColumn("is_volume", F.lit(False)).withColumn("is_volatility", F.lit(True)))
    )


# ---- candles and momentum (D5-D8) -----------------------------------------------------------------


def candles(trades: DataFrame, candle_ms: int, session: tuple[str, ...] = ()) -> DataFrame:
    """One row per (symbol, minute with trades); partial aggregation keeps the shuffle at candle size."""
    arrival = arrival_order(F.pmod("t", F.lit(candle_ms)), F.col("seq"), candle_ms)
    return trades.groupBy("s", *session, bucket("t", candle_ms).alias("minute")).agg(
        F.min_by("p", arrival).alias("open"),
        F.max("p").alias("high"),
        F.min("p").alias("low"),
        F.max_by("p", arrival).alias("close"),
        F.sum("v").alias("volume"),
        F.min("t").alias("first_t"),
        F.min_by("seq", arrival).alias("first_seq"),
    )


def completed_candles(bars: DataFrame, session: tuple[str, ...] = ()) -> DataFrame:
    """Candles that a trade of a later minute has closed, with that trade's time and arrival number."""
    keyed = bars.withColumn("_day", bucket("minute", 1440))
    following = next_value(keyed, ["s", *session], "_day", "minute", F.struct("first_t", "first_seq"), "_close")
    return (
        following.filter(F.col("_close").isNotNull())
        .withColumn("close_t", F.col("_close.first_t"))
        .withColumn("close_seq", F.col("_close.first_seq"))
        .drop("_close", "_day")
    )


def late_flags(trades: DataFrame, candle_ms: int, arrival: str, arrivals_per_block: int) -> DataFrame:
    """Flag trades that arrive after a trade of a later minute of their symbol; candles ignore them.

    ``arrival`` is a unique arrival number, so a block holds at most ``arrivals_per_block`` rows of a key.
    """
    keyed = trades.withColumn("_minute", bucket("t", candle_ms)).withColumn("_block", bucket(arrival, arrivals_per_block))
    seen = running(keyed, ["s"], "_block", [arrival], {"_newest": ("max", "_minute")}, include_current=False)
    return seen.withColumn("is_late", F.coalesce(F.col("_minute") < F.col("_newest"), F.lit(False))).drop(
        "_minute", "_block", "_newest"
    )


def momentum_candidates(completed: DataFrame, cfg: Settings, session: tuple[str, ...] = ()) -> DataFrame:
    """At each candle close: the direction most of the last candles agree on."""
    keys, n = ["s", *session], cfg.momentum_candles
    ranked = numbered(completed.withColumn("_day", bucket("minute", 1440)), keys, "_day", ["minute"])
    runs = with_preceding(ranked, "rn", n - 1)
    last = Window.partitionBy(*keys, "_run").orderBy("rn").rowsBetween(-(n - 1), 0)
    up = F.sum((F.col("close") >= F.col("open")).cast("int")).over(last)
    framed = runs.select(
        *keys,
        "_copy",
        "minute",
        "close",
        "close_t",
        "close_seq",
        F.count(F.lit(1)).over(last).alias("_n"),
        up.alias("_up"),
        F.first("open").over(last).alias("oldest_open"),
        F.first("minute").over(last).alias("_oldest"),
    )
    down = F.lit(n) - F.col("_up")
    direction = F.when(F.col("_up") >= cfg.momentum_min_agree, F.lit("UP")).when(
        down >= cfg.momentum_min_agree, F.lit("DOWN")
    )
    return (
        framed.filter((F.col("_n") == n) & ~F.col("_copy"))
        .withColumn("direction", direction)
        .filter(F.col("direction").isNotNull())
        .select(
            F.col("s").alias("symbol"),
            *session,
            "direction",
            F.when(F.col("direction") == "UP", F.col("_up")).otherwise(down).cast("int").alias("candles_in_direction"),
            F.lit(n).cast("int").alias("total_candles"),
            "oldest_open",
            F.col("close").alias("latest_close"),
            half_even((F.col("close") - F.col("oldest_open")) / F.col("oldest_open") * 100, 3).alias("pct_change"),
            (F.col("_oldest") * cfg.candle_ms).alias("window_start_ts"),
            ((F.col("minute") + 1) * cfg.candle_ms).alias("window_end_ts"),
            F.col("close_t").alias("trade_ts"),
            F.col("close_seq").alias("seq"),
        )
    )


def momentum_signals(candidates: DataFrame, cfg: Settings, session: tuple[str, ...] = ()) -> DataFrame:
    return cooldown_thin(candidates, ["symbol", *session], "trade_ts", "seq", cfg.momentum_cooldown_ms)


# ---- sector state and snapshots (D10-D14) ---------------------------------------------------------


def sector_state(trades: DataFrame, block_ms: int, session: tuple[str, ...] = ()) -> DataFrame:
    """Each trade with its symbol's session so far: open, last, count, volume, last time, percent change."""
    keys = ["s", *session]
    state = running(
        time_blocks(trades, keys, "t", "seq", block_ms),
        keys,
        "_block",
        ["t", "seq"],
        {"open_price": ("first", "p"), "trade_count": ("count", "p"), "total_volume": ("sum", "v")},
        place=arrival_order(F.pmod("t", F.lit(block_ms)), F.col("seq"), block_ms),
    )
    return state.select(
        *keys,
        "t",
        "seq",
        "open_price",
        F.col("p").alias("last_price"),
        "trade_count",
        "total_volume",
        half_even((F.col("p") - F.col("open_price")) / F.col("open_price") * 100, 3).alias("pct_change"),
    )


def tick_states(trades: DataFrame, snapshot_ms: int) -> DataFrame:
    """Trades folded to one row per (symbol, snapshot tick that first sees them)."""
    arrival = arrival_order(F.pmod(F.col("t") - 1, F.lit(snapshot_ms)), F.col("seq"), snapshot_ms)
    tick = F.expr(f"(t + {snapshot_ms - 1}L) div {snapshot_ms}L")
    return trades.groupBy("s", tick.alias("tick")).agg(
        F.min_by("p", arrival).alias("open"),
        F.max_by("p", arrival).alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.sum("v").alias("volume"),
        F.min("t").alias("first_t"),
        F.max("t").alias("last_t"),
    )


def sector_snapshots(ticks: DataFrame, symbols: DataFrame, cfg: Settings) -> DataFrame:
    """State of every symbol at every tick, symbols without trades included.

    ``symbols`` has one column ``s``. Ticks are multiples of the interval; the first one follows the first trade.
    """
    # One row per symbol; the ends of the whole feed come from a frame over these few rows.
    own = ticks.groupBy("s").agg(F.min("first_t").alias("_from"), F.max("last_t").alias("_to"))
    everyone = Window.partitionBy(F.lit(0))
    reach = symbols.join(own, "s", "left").select("s", F.min("_from").over(everyone).alias("_t0"), F.max("_to").over(everyone).alias("_t1"))
    reach = reach.withColumn("_t0", bucket("_t0", cfg.snapshot_ms) + 1).withColumn("_t1", bucket("_t1", cfg.snapshot_ms))
    return snapshots_within(ticks, reach, cfg)


def snapshots_within(ticks: DataFrame, reach: DataFrame, cfg: Settings) -> DataFrame:
    """State of each key ``s`` of ``reach`` at its ticks from ``_t0`` to ``_t1``.

    Days are accumulated first, so each (key, day) fills its own ticks independently.
    """
    step, per_day = cfg.snapshot_ms, max(DAY_MS // cfg.snapshot_ms, 1)
    daily = ticks.groupBy("s", bucket("tick", per_day).alias("_day")).agg(
        F.min_by("open", "tick").alias("_open"),
        F.max_by("last", "tick").alias("_last"),
        F.sum("n").alias("_n"),
        F.sum("volume").alias("_volume"),
        F.max("last_t").alias("_last_t"),
    )
    days = reach.filter(F.col("_t1") >= F.col("_t0")).withColumn(
        "_day", F.explode(F.sequence(bucket("_t0", per_day), bucket("_t1", per_day)))
    )
    before = Window.partitionBy("s").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    inherited = days.join(daily, ["s", "_day"], "left").select(
        "s",
        "_day",
        "_t0",
        "_t1",
        F.first("_open", True).over(before).alias("_open"),
        F.last("_last", True).over(before).alias("_last"),
        F.sum("_n").over(before).alias("_n"),
        F.sum("_volume").over(before).alias("_volume"),
        F.max("_last_t").over(before).alias("_last_t"),
    )
    first_tick = F.greatest(F.col("_t0"), F.col("_day") * per_day)
    last_tick = F.least(F.col("_t1"), F.col("_day") * per_day + per_day - 1)
    grid = inherited.withColumn("tick", F.explode(F.sequence(first_tick, last_tick))).withColumn("_grid", F.lit(1))
    fills = ticks.drop("first_t").withColumn("_day", bucket("tick", per_day)).withColumn("_grid", F.lit(0))
    so_far = (
        Window.partitionBy("s", "_day").orderBy("tick", "_grid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = grid.unionByName(fills, True).select(
        "s",
        "tick",
        "_grid",
        F.coalesce(F.col("_open"), F.first("open", True).over(so_far)).alias("open_price"),
        F.coalesce(F.last("last", True).over(so_far), F.col("_last")).alias("last_price"),
        (F.coalesce("_n", F.lit(0)) + F.coalesce(F.sum("n").over(so_far), F.lit(0))).alias("trade_count"),
        (F.coalesce("_volume", F.lit(0.0)) + F.coalesce(F.sum("volume").over(so_far), F.lit(0.0))).alias("total_volume"),
        F.coalesce(F.max("last_t").over(so_far), F.col("_last_t")).alias("last_trade_ts"),
    )
    at = F.col("tick") * step
    return filled.filter(F.col("_grid") == 1).select(
        at.alias("snapshot_ms"),
        F.col("s").alias("symbol"),
        "last_price",
        "open_price",
        half_even((F.col("last_price") - F.col("open_price")) / F.col("open_price") * 100, 3).alias("pct_change"),
        F.col("trade_count").cast("int").alias("trade_count"),
        "total_volume",
        "last_trade_ts",
        F.coalesce(at - F.col("last_trade_ts") > cfg.stale_ms, F.lit(False)).alias("is_stale"),
    )


def symbol_table(spark, symbols: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in symbols], "s string")


SNAPSHOT_FIELDS = (
    "symbol",
    "last_price",
    "open_price",
    "pct_change",
    "trade_count",
    "total_volume",
    "last_trade_ts",
    "is_stale",
)


def nest_snapshots(flat: DataFrame) -> DataFrame:
    """One record per tick with its symbols as a sorted array; the array has one entry per symbol."""
    return flat.groupBy("snapshot_ms").agg(
        F.array_sort(F.collect_list(F.struct(*SNAPSHOT_FIELDS))).alias("symbols")
    )


def explode_snapshots(nested: DataFrame, time_column: str) -> DataFrame:
    """One row per (tick, symbol) from nested records."""
    return nested.select(time_column, F.explode("symbols").alias("_e")).select(
        time_column, *[F.col(f"_e.{c}").alias(c) for c in SNAPSHOT_FIELDS]
    )


# ---- sessions, replay, fan-out (D14-D17) ----------------------------------------------------------


def with_sessions(trades: DataFrame, gap_ms: int) -> DataFrame:
    """Add ``session_id`` per symbol: a new session begins after a silence longer than the gap.

    Two trades in one gap-wide cell are never further apart than the gap, so breaks fall between cells and
    only one row per non-empty cell has to be put in order.
    """
    keyed = trades.withColumn("_cell", bucket("t", gap_ms))
    in_order = Window.partitionBy("s").orderBy("_cell")
    cells = keyed.groupBy("s", "_cell").agg(F.min("t").alias("_from"), F.max("t").alias("_to"))
    broken = F.coalesce(F.col("_from") - F.lag("_to").over(in_order) > gap_ms, F.lit(False))
    sessions = (
        cells.withColumn("_break", broken.cast("int"))
        .withColumn("session_id", F.sum("_break").over(in_order))
        .select("s", "_cell", "session_id")
    )
    return keyed.join(sessions, ["s", "_cell"]).drop("_cell")


def replay_from(trades: DataFrame, start_ms: int, lookback_ms: int) -> DataFrame:
    """The trades a restarted detector reads: the last stretch before ``start_ms`` rebuilds its state."""
    return trades.filter(F.col("t") >= start_ms - lookback_ms)


def since(signals: DataFrame, start_ms: int) -> DataFrame:
    """Signals that fire at or after the restart; those of the replayed stretch are discarded."""
    return signals.filter(F.col("trade_ts") >= start_ms)


#: Between a symbol and the number of its session, which together stand in for the symbol.
SESSION_MARK = "\x1f"


def apart(trades: DataFrame, gap_ms: int) -> DataFrame:
    """Trades whose symbol is joined with its session's number."""
    return with_sessions(trades, gap_ms).withColumn("s", F.concat_ws(SESSION_MARK, "s", "session_id")).drop("session_id")


def session_shown(rows: DataFrame) -> DataFrame:
    """Symbol and ``session_id`` again as two columns."""
    session = F.substring_index("symbol", SESSION_MARK, -1).cast("bigint")
    return rows.withColumn("session_id", session).withColumn("symbol", F.substring_index("symbol", SESSION_MARK, 1))


def detect_in_sessions(
    trades: DataFrame, cfg: Settings, gap_ms: int, detectors: Sequence[Detector] | None = None
) -> DataFrame:
    """Signals of any detectors that start anew with each session, with ``session_id``.

    A symbol's session stands in for the symbol, so no window, candle or cooldown reaches across a silence. For history,
    ``plans.gold.SessionPipeline`` gives the same for the three built-in ones and writes the steps between once.
    """
    return session_shown(detect(apart(trades, gap_ms), cfg, DETECTORS if detectors is None else detectors))


def warm_start(trades: DataFrame, cfg: Settings, start_ms: int, detectors: Sequence[Detector] | None = None) -> DataFrame:
    """Signals of detectors restarted at ``start_ms``: the stretch before it sets their state, its signals are dropped."""
    replayed = replay_from(trades, start_ms, cfg.warm_start_ms)
    return since(detect(replayed, cfg, DETECTORS if detectors is None else detectors), start_ms)


@dataclass(frozen=True)
class Detector:
    """A detector as data: what it calls its signals, how it finds candidates, how long it then rests.

    ``candidates(trades, cfg)`` returns rows with at least ``symbol``, ``trade_ts`` and ``seq``. Any function
    of that shape can be plugged in.
    """

    signal_type: str
    candidates: Callable[[DataFrame, Settings], DataFrame]
    cooldown_ms: Callable[[Settings], int]

    def detect(self, trades: DataFrame, cfg: Settings) -> DataFrame:
        found = self.candidates(trades, cfg)
        return cooldown_thin(found, ["symbol"], "trade_ts", "seq", self.cooldown_ms(cfg)).withColumn(
            "signal_type", F.lit(self.signal_type)
        )


DETECTORS = (
    Detector("volume_spike", volume_candidates, lambda cfg: cfg.volume_cooldown_ms),
    Detector(
        "momentum_signal",
        lambda trades, cfg: momentum_candidates(completed_candles(candles(trades, cfg.candle_ms)), cfg),
        lambda cfg: cfg.momentum_cooldown_ms,
    ),
    Detector("volatility_spike", volatility_candidates, lambda cfg: cfg.volatility_cooldown_ms),
)


def detect(trades: DataFrame, cfg: Settings, detectors: Sequence[Detector] = DETECTORS) -> DataFrame:
    """The signals of several detectors as one feed, keeping every field of each.

    For history, ``plans.gold.Pipeline`` gives the same and writes the steps between once.
    """
    found = [x.detect(trades, cfg) for x in detectors]
    return reduce(lambda a, b: a.unionByName(b, True), found).withColumn("detected_at", ms_to_iso(F.col("trade_ts")))


def unify(volume: DataFrame, momentum: DataFrame, volatility: DataFrame) -> DataFrame:
    """The three signal kinds as one feed, keeping every field of each."""
    parts = [
        volume.withColumn("signal_type", F.lit("volume_spike")),
        momentum.withColumn("signal_type", F.lit("momentum_signal")),
        volatility.withColumn("signal_type", F.lit("volatility_spike")),
    ]
    return reduce(lambda a, b: a.unionByName(b, True), parts).withColumn("detected_at", ms_to_iso(F.col("trade_ts")))


def feed(volume: DataFrame, momentum: DataFrame, volatility: DataFrame) -> DataFrame:
    """The same feed cut to the common columns: kind, time, strength, price."""

    def common(df, kind, strength, price):
        return df.select(
            "symbol",
            ms_to_ts(F.col("trade_ts")).alias("detected_at"),
            F.lit(kind).alias("signal_type"),
            strength.alias("strength"),
            F.col(price).alias("price"),
            "trade_ts",
            "seq",
        )

    return (
        common(volume, "volume_spike", F.col("spike_ratio"), "price")
        .unionByName(common(momentum, "momentum_signal", F.abs("pct_change"), "latest_close"))
        .unionByName(common(volatility, "volatility_spike", F.col("z_score"), "price"))
    )
