from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tradeloom.config import Settings
from tradeloom.functions.columns import signal_score, two_places_or_na
from tradeloom.plans import dashboard as q
from tradeloom.plans import presentation as show

CFG = Settings()
DAY, AS_OF = date(2024, 3, 15), datetime(2024, 3, 15, 12, 0, 0)

VOLUME = "symbol string, detected_at timestamp, price double, spike_ratio double, ml_anomaly_score double"
MOMENTUM = (
    "symbol string, detected_at timestamp, direction string, latest_close double, pct_change double, ml_anomaly_score double"
)
VOLATILITY = "symbol string, detected_at timestamp, price double, z_score double, ml_anomaly_score double"
SECTOR = (
    "symbol string, snapshot_ts timestamp, last_price double, open_price double, pct_change double, "
    "trade_count int, is_stale boolean"
)


@pytest.fixture
def gold(spark):
    def build(volume=(), momentum=(), volatility=(), sector=()):
        def frame(rows, ddl, ts):
            names = [c.strip().split(" ")[0] for c in ddl.split(",")]
            full = [tuple(_moment(r.get(n)) if n == ts else r.get(n) for n in names) for r in rows]
            return spark.createDataFrame(full, ddl).withColumn("date", F.to_date(ts))

        return SimpleNamespace(
            volume_spikes=frame(volume, VOLUME, "detected_at"),
            momentum_signals=frame(momentum, MOMENTUM, "detected_at"),
            volatility_spikes=frame(volatility, VOLATILITY, "detected_at"),
            sector_snapshots=frame(sector, SECTOR, "snapshot_ts"),
        )

    return build


def _moment(text):
    from zoneinfo import ZoneInfo

    text = text if " " in text else f"{DAY} {text}"
    return datetime.fromisoformat(text).replace(tzinfo=ZoneInfo("UTC"))


def spike(at, symbol="a", price=100.0, ratio=4.0, score=None):
    return dict(symbol=symbol, detected_at=at, price=price, spike_ratio=ratio, ml_anomaly_score=score)


def move(at, symbol="a", pct=0.3, direction="UP", score=None):
    return dict(symbol=symbol, detected_at=at, direction=direction, latest_close=7.0, pct_change=pct, ml_anomaly_score=score)


def snap(at, symbol="a", price=100.0, pct=None):
    return dict(symbol=symbol, snapshot_ts=at, last_price=price, open_price=1.0, pct_change=pct, trade_count=1, is_stale=False)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_breadth(spark, gold):
    g = gold(sector=[snap("10:00:00", "a", pct=9.0), snap("10:01:00", "b", pct=-1.0), snap("10:01:00", "a", pct=1.0)])
    assert [(r.symbol, r.pct_change) for r in q.market_breadth(g).collect()] == [("a", 1.0), ("b", -1.0)]


@pytest.mark.parametrize(
    "up, down, none, verdict", [(5, 3, 2, "MIXED"), (6, 3, 1, "BULLISH"), (3, 6, 0, "BEARISH"), (0, 0, 0, "MIXED")]
)
def test_verdict(spark, up, down, none, verdict):
    data = [(1.0,)] * up + [(-1.0,)] * down + [(None,)] * none
    (r,) = show.breadth_verdict(spark.createDataFrame(data, "pct_change double")).collect()
    assert tuple(r) == (up, down, none, verdict)


def test_clusters(gold):
    g = gold(
        volume=[spike("11:20:10", "a"), spike("11:20:20", "a"), spike("11:30:00", "a"), spike("10:59:59", "z")],
        momentum=[move("11:21:59", "b"), move("11:31:00", "b"), move("11:21:00", "b")],
        volatility=[dict(symbol="c", detected_at="11:31:59.999", price=1.0, z_score=3.0)],
    )
    # Four signals of two symbols are no cluster, three of three are.
    assert rows(q.signal_clusters(g, AS_OF, CFG)) == [(datetime(2024, 3, 15, 11, 30), 3, 3)]


def test_leaderboard(gold):
    g = gold(volume=[spike("01:00:00", s) for s in "aabcdef"] + [spike("2024-03-14 23:59:59", "f")] * 3)
    assert rows(q.session_leaderboard(g, AS_OF)) == [("a", 2), ("b", 1), ("c", 1), ("d", 1), ("e", 1)]


def test_opening_range(gold):
    sector = [snap("09:00:00", price=10.0), snap("10:00:00", price=12.0), snap("10:00:00.001", price=50.0)]
    spikes = [spike("10:00:00", price=99.0), spike("10:01:00", price=12.01), spike("10:02:00", price=12.0), spike("10:03:00", price=9.99)]
    g = gold(volume=spikes + [spike("10:05:00", "nosnap")], sector=sector)
    out = q.opening_range(g, DAY, CFG)
    assert [(r.price, r.orb_status) for r in out.collect()] == [(9.99, "BREAKOUT_DOWN"), (12.0, "IN_RANGE"), (12.01, "BREAKOUT_UP")]
    assert show.orb_breakouts(out).count() == 2
    # In exchange time the range ends at 14:00 UTC, after all of these.
    assert q.opening_range(g, DAY, CFG, tz="America/New_York").count() == 0


def test_realtime_feed_and_score(gold):
    g = gold(
        volume=[spike("11:55:00", ratio=4.0, score=0.8), spike("11:49:59", ratio=9.0)],
        momentum=[move("11:56:00", pct=-0.1)],
        volatility=[dict(symbol="a", detected_at="11:57:00", price=3.0, z_score=2.5, ml_anomaly_score=0.74)],
    )
    live = q.all_realtime_signals(g, AS_OF, CFG)
    got = [(r.signal_type, r.strength, r.price, r.score) for r in show.with_score(live).collect()]
    assert got == [("volatility_spike", 2.5, 3.0, 8), ("momentum_signal", 0.1, 7.0, 1), ("volume_spike", 4.0, 100.0, 8)]
    assert [r.signal_type for r in show.top_active(live, 2).collect()] == ["volatility_spike", "volume_spike"]
    assert [r.ml_text for r in show.top_active(live).collect()] == ["0.74", "0.80", "N/A"]
    assert rows(show.signal_mix(live).orderBy("signal_type")) == [("momentum_signal", 1), ("volatility_spike", 1), ("volume_spike", 1)]
    assert show.ml_confirmed_live(live, 0.75).count() == 1
    assert show.symbol_filter(live, []).count() == 3
    assert show.symbol_filter(live, ["b"]).count() == 0


def test_score_limits(spark):
    data = [("volume_spike", 9.0), ("volume_spike", 0.1), ("volatility_spike", 2.5), ("momentum_signal", -0.6), ("other", 1.0)]
    df = spark.createDataFrame(data, "k string, x double").select(signal_score(F.col("k"), F.col("x")))
    assert [r[0] for r in df.collect()] == [10, 1, 8, 4, 5]
    assert spark.range(1).select(two_places_or_na(F.lit(0.815))).first()[0] == "0.81"


def test_rvol(gold):
    today = [spike(f"10:0{i}:00") for i in range(6)] + [spike("11:00:00")]
    history = [spike(f"2024-03-10 10:0{i}:00") for i in range(4)] + [spike(f"2024-03-11 10:0{i}:00") for i in range(2)]
    outside = [spike("2024-02-13 23:59:59")]
    out = q.rvol(gold(volume=today + history + outside), DAY)
    assert rows(out) == [(10, 6, 3.0, 2.0), (11, 1, 0.0, None)]
    assert [r.color for r in show.rvol_colored(out).collect()] == ["green", "red"]


def test_best_hours(spark, gold):
    out = q.best_hours(gold(volume=[spike("10:00:00", ratio=4.0), spike("10:59:00", ratio=6.0)]), DAY)
    assert rows(out) == [(10, 2, 5.0, 6.0)]


def test_strength_counts_joined_rows(gold):
    spikes = [spike("10:00:00", ratio=4.5), spike("11:00:00", ratio=4.9), spike("10:00:00", "b", ratio=15.0)]
    sector = [snap("10:15:00", pct=-2.0), snap("10:30:00", pct=1.0), snap("10:30:00.001", pct=50.0), snap("10:14:59.999", pct=50.0)]
    out = q.signal_strength(gold(volume=spikes, sector=sector), AS_OF, CFG)
    assert rows(out) == [("Mild (4-5x)", 3, 1.5), ("Extreme (12x+)", 1, None)]


def test_confirmation_counts_second_boundaries(gold):
    g = gold(volume=[spike("00:00:00.900")], momentum=[move("00:05:00.950"), move("00:05:01.000"), move("2024-03-14 23:58:00")])
    assert [(r.seconds_apart, r.direction) for r in q.multi_signal_confirmation(g, DAY, CFG).collect()] == [(-120, "UP"), (300, "UP")]


def test_pairs(gold):
    spikes = [spike("10:00:00", "a"), spike("10:00:00.500", "a"), spike("10:10:00", "b"), spike("10:10:01", "c")]
    night = [spike("2024-03-14 23:59:59", "a"), spike("00:00:01", "c")]
    out = q.stock_correlation(gold(volume=spikes + night), AS_OF, CFG)
    assert rows(out) == [("a", "b", 2), ("b", "c", 1)]
    assert rows(show.top_pairs(out, 1)) == [("a/b", 2)]


def test_regime_and_rotation(spark, gold):
    vol = [dict(symbol="a", detected_at=t, price=1.0, z_score=z) for t, z in (("10:00:00", 3.0), ("11:00:00", 5.0), ("2024-03-08 00:00:00", 4.0), ("2024-03-07 23:59:59", 9.0))]
    g = gold(volume=[spike("10:30:00")], momentum=[move("10:31:00")], volatility=vol)
    assert rows(q.volatility_regime(g, AS_OF)) == [(datetime(2024, 3, 8), 1, 4.0, 4.0), (datetime(2024, 3, 15), 2, 4.0, 5.0)]
    assert rows(q.sector_rotation(g, DAY)) == [(10, "momentum", 1), (10, "volatility", 1), (10, "volume", 1), (11, "volatility", 1)]


def test_accuracy_and_win_rates(gold):
    spikes = [spike("10:00:00"), spike("10:02:00"), spike("10:04:00", price=50.0), spike("10:06:00", price=99.0), spike("20:00:00", price=1.0)]
    sector = [snap("10:20:00", price=101.0), snap("10:21:00", price=103.0)]
    g = gold(volume=spikes, sector=sector)
    (r,) = q.signal_accuracy(g, AS_OF, CFG).collect()
    # Exit 102 for three and 103 for the last; the spike without an exit price is left out.
    assert (r.total_signals, r.wins, r.win_rate_pct, r.wins_2pct) == (4, 4, 100.0, 4)
    assert r.avg_return_pct == pytest.approx((2 + 2 + 104 + 4.040404) / 4, abs=1e-3)
    (w,) = q.symbol_win_rates(g, AS_OF, CFG).collect()
    # The two spikes at 100 count as one.
    assert (w.symbol, w.total, w.win_rate_pct) == ("a", 3, 100.0)
    assert q.signal_accuracy(g, AS_OF, CFG, min_ratio=5.0).first().total_signals == 0


def test_pnl_takes_the_first_in_each_band(gold):
    sector = [snap("10:04:00", price=1.0), snap("10:05:00", price=2.0), snap("10:06:01", price=3.0), snap("10:16:00", price=4.0), snap("10:31:00.001", price=5.0)]
    g = gold(volume=[spike("10:00:00", score=0.5), spike("15:00:00")], sector=sector)
    out = q.per_signal_pnl(g, AS_OF, CFG).collect()
    assert [(r.exit_5min, r.exit_15min, r.exit_30min, r.ml_anomaly_score) for r in out] == [(None, None, None, None), (1.0, 4.0, None, 0.5)]
    assert [r.symbol for r in q.per_signal_pnl(g, AS_OF, CFG, top=1).collect()] == ["a"]


def test_score_reports(gold):
    g = gold(
        volume=[spike("10:00:00", score=0.75), spike("10:01:00", score=1.0), spike("10:02:00")],
        momentum=[move("10:00:00", pct=-2.0, score=0.9)],
        volatility=[dict(symbol="a", detected_at="10:00:00", price=1.0, z_score=3.0, ml_anomaly_score=0.05)],
    )
    dist = q.ml_score_distribution(g, DAY)
    assert dist.columns == ["ml_anomaly_score", "signal_type"]
    assert dist.count() == 4
    assert {r.signal_type for r in q.ml_score_vs_strength(g, DAY).collect()} == {"volume_spike", "volatility_spike"}
    assert [(r.ml_anomaly_score, r.strength) for r in q.ml_confirmed_signals(g, DAY, CFG).collect()] == [(1.0, 4.0), (0.9, 2.0), (0.75, 4.0)]
    (p,) = show.score_percentiles(dist).collect()
    assert (p.p50, p.p90) == (pytest.approx(0.825), pytest.approx(0.97))
    assert sorted(rows(show.score_histogram(dist))) == [("momentum_signal", 19, 1), ("volatility_spike", 2, 1), ("volume_spike", 16, 1), ("volume_spike", 20, 1)]


def test_percentiles_equal_numpy(spark):
    import numpy as np

    from tradeloom.functions.percentiles import exact_percentiles

    rng = np.random.default_rng(3)
    for values in (rng.random(997), np.repeat([0.25, 0.5, 0.5000001], [600, 3, 200]), np.array([0.3]), rng.beta(0.2, 0.2, 500).round(2)):
        df = spark.createDataFrame([(float(x),) for x in values], "x double").repartition(4)
        r = exact_percentiles(df, "x", {"a": 0.5, "b": 0.9, "c": 0.99, "d": 0.0, "e": 1.0}).first()
        assert list(r) == pytest.approx(list(np.percentile(values, [50, 90, 99, 0, 100])))


def test_filters_reach_the_partitions(spark, tmp_path, gold):
    gold(volume=[spike("10:00:00"), spike("2024-03-01 10:00:00")]).volume_spikes.write.partitionBy("date").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = q.on_day(stored, DAY)._jdf.queryExecution().executedPlan().toString()
    partition = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "date" in partition and "2024-03-15" in partition
    assert "GreaterThanOrEqual(detected_at" in plan


@pytest.mark.parametrize("report", [q.signal_strength, q.signal_accuracy, q.symbol_win_rates, q.per_signal_pnl])
def test_snapshots_are_pruned_by_day(spark, gold, tmp_path, report):
    g = gold(volume=[spike("10:00:00")], sector=[snap("10:10:00", pct=1.0), snap("2023-01-01 10:10:00", pct=1.0)])
    g.sector_snapshots.write.partitionBy("date").parquet(str(tmp_path / "s"))
    g.sector_snapshots = spark.read.parquet(str(tmp_path / "s"))
    plan = report(g, AS_OF, CFG)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan") :]
    assert "PartitionFilters: [isnotnull(date" in scan and ">=" in scan.split("PartitionFilters:")[1].split("]")[0]


def test_percentiles_of_crowded_values(spark):
    """Nearly all distinct values within a hair of each other: bins are narrowed until they tell them apart."""
    import numpy as np

    from tradeloom.functions.percentiles import exact_percentiles

    rng = np.random.default_rng(4)
    values = np.concatenate([[0.0, 1.0], 0.5 + 1e-9 * rng.random(3000), np.full(500, 0.5)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    r = exact_percentiles(df, "x", {"a": 0.3, "b": 0.5, "c": 0.999}, bins=16).first()
    assert list(r) == pytest.approx(list(np.percentile(values, [30, 50, 99.9])), abs=1e-15)
    assert list(exact_percentiles(df.filter("x > 2"), "x", {"a": 0.5}).first()) == [None]


def test_sql_over_gold(spark, gold):
    g = gold(volume=[spike("10:00:00"), spike("11:00:00", "b", ratio=9.0)], sector=[snap("10:00:00")])
    text = "SELECT v.symbol, s.last_price FROM {volume_spikes} v JOIN {sector_snapshots} s USING (symbol) WHERE spike_ratio < :most"
    assert rows(q.run_sql(spark, g, text, most=5.0)) == [("a", 100.0)]


@pytest.mark.parametrize("seconds", [0, 1, 7, 600])
def test_co_spikes_equal_all_pairs(spark, seconds):
    """Dense and sparse symbols, equal seconds, two days: the sweep counts what a comparison of all pairs counts."""
    import random
    from collections import Counter

    rng = random.Random(seconds)
    start = 1_700_005_000  # the day ends within the spikes
    rows = [(rng.choice("aabcd"), start + rng.randrange(3600)) for _ in range(300)]
    rows += [("e", start + 500)] * 40 + [("f", start + 500 + seconds)] * 30 + [("g", start + 501 + seconds)] * 20
    spikes = spark.createDataFrame(rows, "symbol string, second long").withColumn("detected_at", F.timestamp_seconds("second"))
    found = q.co_spikes(spikes.withColumn("date", F.to_date("detected_at")), seconds)
    want = Counter()
    for i, (s, x) in enumerate(rows):
        for r, y in rows[:i]:
            if s != r and abs(x - y) <= seconds and x // 86_400 == y // 86_400:
                want[min(s, r), max(s, r)] += 1
    assert {(r.symbol_a, r.symbol_b): r.co_signal_count for r in found.collect()} == want


def test_co_spikes_meet_by_stretch_not_by_second(spark):
    """Two symbols that spike in each of an hour's seconds: the joins give a row for each pair of stretches."""
    rows = [(s, 1_700_000_000 + x) for s in "ab" for x in range(3600)]
    spikes = spark.createDataFrame(rows, "symbol string, second long").withColumn("detected_at", F.timestamp_seconds("second"))
    found = q.co_spikes(spikes.withColumn("date", F.to_date("detected_at")), 600)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join Inner") == 2 and "second" in text
    cells = 3600 // 601 + 2
    assert found.first().co_signal_count == sum(min(3599, x + 600) - max(0, x - 600) + 1 for x in range(3600))
    assert spikes.groupBy("symbol", F.expr("second div 601")).count().count() <= 2 * cells
