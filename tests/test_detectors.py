import random

import pytest
from simulate import simulate

from tradeloom.config import Settings
from tradeloom.operators import detectors as d
from tradeloom.plans.gold import Pipeline

CFG = Settings()


def volume(trades, rows):
    return [tuple(r) for r in d.volume_candidates(trades(rows), CFG).orderBy("trade_ts", "seq").collect()]


V = "a"


def test_volume_fires(trades):
    (r,) = d.volume_candidates(trades([(V, t, 5, 10) for t in (0, 20, 40)] + [(V, 60, 5, 40)]), CFG).collect()
    assert (r.avg_volume, r.spike_ratio, r.window_trade_count, r.window_span_secs, r.trade_ts) == (10.0, 4.0, 4, 60.0, 60_000)


@pytest.mark.parametrize(
    "rows",
    [
        [(V, 0, 5, 10), (V, 20, 5, 10), (V, 40, 5, 10), (V, 60, 5, 39.99)],
        [(V, 0, 5, 10), (V, 20, 5, 10), (V, 40, 5, 10), (V, 59.999, 5, 40)],
        [(V, 0, 5, 0), (V, 30, 5, 0), (V, 60, 5, 5)],
        [(V, 0, 5, 10), (V, 1, 5, 1), (V, 300, 5, 8)],
        [(V, 0, 5, 10)],
    ],
    ids=["below", "short span", "zero mean", "edge kept", "one trade"],
)
def test_volume_quiet(trades, rows):
    assert volume(trades, rows) == []


def test_volume_prunes_after_the_window(trades):
    (r,) = d.volume_candidates(trades([(V, 0, 5, 10), (V, 1, 5, 1), (V, 300.001, 5, 8)]), CFG).collect()
    assert (r.avg_volume, r.spike_ratio) == (1.0, 8.0)


def test_volume_ties_see_earlier_arrivals_only(trades):
    rows = [(V, 0, 5, 10), (V, 30, 5, 10), (V, 60, 5, 40), (V, 60, 5, 200)]
    found = d.volume_candidates(trades(rows), CFG)
    assert [(r.seq, r.spike_ratio) for r in found.orderBy("seq").collect()] == [(2, 4.0), (3, 10.0)]
    assert [r.seq for r in d.volume_spikes(found, CFG).collect()] == [2]


def test_volatility(trades):
    flat = trades([(V, t, 5, 1) for t in (0, 30, 60)])
    assert d.volatility_candidates(flat, CFG).count() == 0
    rows = [(V, t, 100, 1) for t in range(0, 100, 10)] + [(V, 100, 110, 1)]
    (r,) = d.volatility_candidates(trades(rows), CFG).collect()
    assert (r.window_trade_count, r.mean_price, r.std_dev, r.z_score) == (11, 100.9091, 2.8748, 3.162)
    small = trades([(V, 0, 100, 1), (V, 30, 100, 1), (V, 60, 1000, 1)])
    assert d.volatility_candidates(small, CFG).count() == 0


def test_candles_complete_on_the_next_minute(trades):
    rows = [(V, 0, 1, 1), (V, 10, 3, 1), (V, 59.999, 2, 1), (V, 60, 9, 1)]
    bars = d.candles(trades(rows), CFG.candle_ms)
    (r,) = d.completed_candles(bars).collect()
    assert (r.minute, r.open, r.high, r.low, r.close, r.volume, r.close_t, r.close_seq) == (0, 1, 3, 1, 2, 3, 60_000, 3)
    gaps = d.candles(trades([(V, 0, 1, 1), (V, 300, 1, 1), (V, 360, 1, 1)]), CFG.candle_ms)
    assert sorted(r.minute for r in d.completed_candles(gaps).collect()) == [0, 5]


def test_candles_complete_across_days(trades):
    bars = d.candles(trades([(V, 0, 1, 1), (V, 5 * 86_400, 2, 1)]), CFG.candle_ms)
    (r,) = d.completed_candles(bars).collect()
    assert r.close_t == 5 * 86_400_000


def test_late_trade_is_flagged(trades):
    flagged = d.late_flags(trades([(V, 61, 1, 1), (V, 59, 1, 1), (V, 62, 1, 1), ("b", 1, 1, 1)]), CFG.candle_ms, "seq", 2)
    assert {r.seq: r.is_late for r in flagged.collect()} == {0: False, 1: True, 2: False, 3: False}


def minutes(prices):
    """Two trades per minute: open and close."""
    rows = [(V, m * 60 + s, p, 1) for m, pair in enumerate(prices) for s, p in zip((0, 30), pair)]
    return rows + [(V, len(prices) * 60, 100, 1)]


@pytest.mark.parametrize(
    "prices, expected",
    [
        ([(5, 5)] * 5, [("UP", 5, 0.0)]),
        ([(10, 9), (9, 10), (10, 9), (9, 10), (10, 8)], [("DOWN", 3, -20.0)]),
        ([(5, 5)] * 4, []),
    ],
    ids=["flat is up", "three down", "too few"],
)
def test_momentum(trades, prices, expected):
    completed = d.completed_candles(d.candles(trades(minutes(prices)), CFG.candle_ms))
    found = d.momentum_candidates(completed, CFG).collect()
    assert [(r.direction, r.candles_in_direction, r.pct_change) for r in found] == expected
    for r in found:
        assert (r.window_start_ts, r.window_end_ts, r.trade_ts) == (0, 300_000, 300_000)


def test_momentum_can_demand_more(trades):
    from dataclasses import replace

    strict = replace(CFG, momentum_min_agree=4)
    completed = d.completed_candles(d.candles(trades(minutes([(1, 2), (2, 1)] * 2 + [(1, 2)])), CFG.candle_ms))
    assert d.momentum_candidates(completed, strict).count() == 0


def snapshots(spark, trades, rows, symbols):
    ticks = d.tick_states(trades(rows), CFG.snapshot_ms)
    return d.sector_snapshots(ticks, d.symbol_table(spark, symbols), CFG)


def test_snapshots(spark, trades):
    rows = [("a", 1, 182.5, 2), ("a", 60, 183.12, 3), ("b", 250, 10, 1)]
    got = {(r.snapshot_ms // 1000, r.symbol): r for r in snapshots(spark, trades, rows, ("a", "b", "c")).collect()}
    assert sorted(got) == [(t, s) for t in (60, 120, 180, 240) for s in "abc"]
    a = got[60, "a"]
    assert (a.open_price, a.last_price, a.pct_change, a.trade_count, a.total_volume) == (182.5, 183.12, 0.34, 2, 5.0)
    c = got[240, "c"]
    assert (c.last_price, c.open_price, c.pct_change, c.trade_count, c.total_volume, c.last_trade_ts, c.is_stale) == (
        None, None, None, 0, 0.0, None, False,
    )
    assert not got[180, "a"].is_stale, "exactly the limit"
    assert got[240, "a"].is_stale
    nested = d.nest_snapshots(snapshots(spark, trades, rows, ("a", "b", "c")))
    assert nested.filter("size(symbols) = 3 and symbols[0].symbol = 'a'").count() == 4
    assert d.explode_snapshots(nested, "snapshot_ms").count() == 12


def test_snapshots_carry_over_days(spark, trades):
    rows = [("a", 30, 10, 1), ("b", 40, 7, 1), ("b", 2 * 86_400 + 61, 8, 1)]
    out = snapshots(spark, trades, rows, ("a", "b"))
    assert out.count() == 2 * (2 * 1440 + 1)
    last = out.filter("symbol = 'a'").orderBy("snapshot_ms", ascending=False).first()
    assert (last.last_price, last.trade_count, last.is_stale) == (10.0, 1, True)


def test_sessions(trades):
    rows = [(V, 0, 1, 1), (V, 100, 1, 1), (V, 201, 1, 1), (V, 1000, 1, 1), ("b", 500, 1, 1)]
    got = d.with_sessions(trades(rows), 100_000)
    assert {r.seq: r.session_id for r in got.collect()} == {0: 0, 1: 0, 2: 1, 3: 2, 4: 0}


def test_session_starts_a_new_window(trades):
    rows = [(V, 0, 5, 10), (V, 40, 5, 10), (V, 250, 5, 40)]
    assert d.volume_candidates(trades(rows), CFG).count() == 1
    in_sessions = d.with_sessions(trades(rows), 100_000)
    assert d.volume_candidates(in_sessions, CFG, ("session_id",)).count() == 0


def test_replay_counts_state_but_not_signals(trades):
    rows = [(V, t, 5, 10) for t in (0, 30)] + [(V, 60, 5, 40), (V, 120, 5, 400), (V, 250, 5, 4000)]
    replayed = d.replay_from(trades(rows), 100_000, CFG.warm_start_ms)
    signals = d.since(d.volume_spikes(d.volume_candidates(replayed, CFG), CFG), 100_000)
    # The spike at 60 is not emitted, but its cooldown holds back the one at 120.
    assert [r.trade_ts for r in signals.collect()] == [250_000]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_simulation(spark, seed):
    rng = random.Random(seed)
    rows, t = [], 1_700_000_000_000
    for i in range(1500):
        t += rng.choice([0, 0, 1000, 3000, 9000, 20_000]) + (rng.random() < 0.004) * 900_000
        price = round(100 + rng.gauss(0, 1) + 15 * (rng.random() < 0.02), 2)
        rows.append((rng.choice("aaabc"), price, round(rng.expovariate(0.1), 2), t, i))
    df = spark.createDataFrame(rows, "s string, p double, v double, t bigint, seq bigint").repartition(4)
    pipe = Pipeline(spark, df, f"simulation-{seed}", CFG)
    volume, volatility, momentum = simulate(rows, CFG)
    assert volume and volatility and momentum

    def got(frame, *columns):
        return sorted(tuple(r) for r in frame.select("symbol", "trade_ts", "seq", *columns).collect())

    assert got(pipe.volume(), "avg_volume", "spike_ratio", "window_trade_count") == sorted(volume)
    assert got(pipe.volatility(), "std_dev", "z_score", "window_trade_count") == sorted(volatility)
    assert got(pipe.momentum(), "direction", "candles_in_direction", "pct_change") == sorted(momentum)
    assert d.feed(pipe.volume(), pipe.momentum(), pipe.volatility()).count() == len(volume + volatility + momentum)


def test_windows_of_different_length(spark):
    from dataclasses import replace

    rng = random.Random(9)
    cfg = replace(CFG, volatility_window_ms=120_000)
    rows = [(rng.choice("ab"), round(100 + rng.gauss(0, 1), 2), round(rng.expovariate(0.1), 2), i * 4000, i) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, p double, v double, t bigint, seq bigint")
    pipe = Pipeline(spark, df, "different windows", cfg)
    volume, volatility, _ = simulate(rows, cfg)
    assert pipe.volume().count() == len(volume)
    assert pipe.volatility().count() == len(volatility)


def test_detectors_can_be_plugged_in(trades):
    from pyspark.sql import functions as F

    def large(rows, cfg):
        return rows.filter("v >= 100").select(F.col("s").alias("symbol"), F.col("t").alias("trade_ts"), "seq")

    mine = d.Detector("large_trade", large, lambda cfg: 10_000)
    rows = [(V, 0, 5, 10), (V, 30, 5, 10), (V, 60, 5, 100), (V, 65, 5, 100), (V, 70, 5, 100)]
    found = d.detect(trades(rows), CFG, (*d.DETECTORS, mine))
    assert sorted((r.signal_type, r.trade_ts) for r in found.collect()) == [
        ("large_trade", 60_000), ("large_trade", 70_000), ("volume_spike", 60_000),
    ]


def test_dense_feeds_get_finer_slices(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), round(rng.gauss(100, 1), 2), 1.0, rng.randrange(700_000), i) for i in range(500)]
    df = spark.createDataFrame(rows, "s string, p double, v double, t bigint, seq bigint")
    coarse = d.rolling_stats(df, 300_000).drop("w_price_mean", "w_price_var")
    monkeypatch.setattr(d, "DENSE_ROWS", 1)
    fine = d.rolling_stats(df, 300_000).drop("w_price_mean", "w_price_var")
    assert sorted(map(tuple, coarse.collect())) == sorted(map(tuple, fine.collect()))
    assert "5000" in fine._jdf.queryExecution().optimizedPlan().toString()


def test_hot_slices_change_nothing(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), round(rng.gauss(100, 1), 2), round(rng.expovariate(0.1), 2), rng.randrange(3000) * 1000, i) for i in range(400)]
    rows += [("a", 101.0 + i % 3, 5.0, 1_500_000, 1000 + i) for i in range(250)]
    df = spark.createDataFrame(rows, "s string, p double, v double, t bigint, seq bigint")
    columns = ["s", "seq", "w_count", "w_from", "w_low", "w_high"]
    got = [d.rolling_stats(df, 300_000, 10, (), hot).select(*columns).collect() for hot in (1_000_000, 20)]
    assert sorted(map(tuple, got[0])) == sorted(map(tuple, got[1]))


def test_sessions_start_every_detector_anew(trades):
    """Each session alone gives what the feed gives in sessions."""
    import random

    rng, rows, t = random.Random(3), [], 1_000.0
    for i in range(1200):
        t += 20_000 if i in (400, 800) else rng.choice([0.5, 2, 5])
        rows.append((rng.choice("ab"), t, round(100 + rng.gauss(0, 1) + 15 * (rng.random() < 0.02), 2), round(rng.expovariate(0.1), 2)))
    feed = trades(rows)
    got = d.detect_in_sessions(feed, CFG, 10_000_000)
    names = ("signal_type", "symbol", "trade_ts", "seq")
    want = []
    for k, (lo, hi) in enumerate(((0, 400), (400, 800), (800, 1200))):
        part = feed.filter(f"seq >= {lo} and seq < {hi}")
        want += [(*r, k) for r in map(tuple, d.detect(part, CFG).select(*names).collect())]
    found = sorted(map(tuple, got.select(*names, "session_id").collect()))
    assert found == sorted(want) and {r[0] for r in found} == {"volume_spike", "momentum_signal", "volatility_spike"}


@pytest.mark.parametrize("scale", [1, 10**9])
def test_threshold_trades_fire_alike_in_every_layout(trades, scale):
    """Trades just at the threshold, at small and at very large volumes, however the windows are cut."""
    from dataclasses import replace

    rows = [("a", 10.0 * i, 10.0, 0.1 * scale) for i in range(60)]
    rows += [("a", 600.0 + 10 * i, 10.0, 0.4 * scale if i % 10 == 9 else 0.1 * scale) for i in range(60)]
    feed, found = trades(rows), []
    for parts in (1, 10, 60):
        cfg = replace(CFG, window_parts=parts)
        found.append(sorted(r.seq for r in d.volume_candidates(feed, cfg).collect()))
    rolled = d.rolling_stats(feed, CFG.volume_window_ms, 10, hot_rows=3)
    found.append(sorted(r.seq for r in rolled.filter(d.is_volume_spike(CFG)).collect()))
    assert found[0] and all(f == found[0] for f in found)


def test_zero_volumes_stay_in_windows(trades):
    rows = [("a", 10.0 * i, 10.0, 0.0) for i in range(20)] + [("a", 300.0, 10.0, 5.0)]
    feed = trades(rows)
    last = d.rolling_stats(feed, CFG.volume_window_ms).filter("seq = 20").first()
    assert last.w_count == 21 and d.volume_candidates(feed, CFG).count() == 0
