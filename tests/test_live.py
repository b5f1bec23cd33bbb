"""Streams with replays, silences, restarts and heartbeats give what the batch operators give."""

import json
import random
import time
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from test_streaming import CFG, SCHEMA, Feed, _fields, cut, rows, wait  # noqa: F401
from tradeloom.functions.columns import ms_to_iso
from tradeloom.operators import detectors as d
from tradeloom.operators import features
from tradeloom.plans import dashboard
from tradeloom.plans.gold import Pipeline, SessionPipeline
from tradeloom.schemas import FEATURE_COLS
from tradeloom.sources import ingest, medallion
from tradeloom.streaming import confirm, jobs

NAMES = ("last_price", "open_price", "pct_change", "trade_count", "total_volume", "last_trade_ts", "is_stale")


class Lines(Feed):
    """A feed of records with a string ``value``."""

    def drop(self, values):
        super().drop([(v,) for v in values])

    def records(self):
        return self.spark.readStream.schema("s string").option("maxFilesPerTrigger", 1).json(self.path).withColumnRenamed("s", "value")


def plain(x):
    return round(x, 6) if isinstance(x, float) else x


def ticks(rows, upto):
    found = {}
    for r in rows:
        if r["snapshot_ms"] <= upto:
            key = (r["snapshot_ms"], r["symbol"])
            assert key not in found
            found[key] = tuple(plain(r[n]) for n in NAMES)
    return found


def streamed(frame, tmp_path, name):
    wait(jobs._start(frame.writeStream.format("parquet"), str(tmp_path / f"c-{name}"), True, path=str(tmp_path / name)))
    return frame.sparkSession.read.parquet(str(tmp_path / name)).collect()


def far(rows, symbols=("z",)):
    """Trades so late that nothing waits for others any more."""
    end = max(r[3] for r in rows)
    return [[(s, 1.0, 1.0, end + k * 10_000_000, 10_000 + 10 * k + i) for i, s in enumerate(symbols)] for k in (1, 2)]


# ---- confirmations ---------------------------------------------------------------------------------


def test_confirmations_equal_the_report(spark, rows, tmp_path):  # noqa: F811
    """Signals out of order by minutes, a third of them delivered again, with broken records in between."""
    trades = spark.createDataFrame(rows, SCHEMA)
    records = ingest.encode_signals(d.detect(trades, CFG).withColumn("ml_anomaly_score", F.lit(None).cast("double")))
    values = [r.value for r in records.collect()]
    rng = random.Random(2)
    at = {v: spark_ms(json.loads(v)["detected_at"]) for v in values}
    arriving = sorted(values, key=lambda v: at[v] + rng.randrange(0, 500_000))
    feed = Lines(spark, tmp_path / "in")
    for i in range(0, len(arriving), 25):
        part = arriving[i : i + 25]
        feed.drop(part + part[::3] + arriving[max(0, i - 40) : i : 4] + ["{broken", '{"signal_type":"mystery"}'])
    late = json.loads(arriving[0])
    out = str(tmp_path / "out")
    wait(confirm.publish_confirmations(confirm.confirmations(feed.records(), CFG), out, str(tmp_path / "c"), once=True))
    feed.drop([json.dumps(late | {"symbol": "later"})])  # behind the watermark
    wait(confirm.publish_confirmations(confirm.confirmations(feed.records(), CFG), out, str(tmp_path / "c"), once=True))
    names = ("symbol", "vol_time", "mom_time", "seconds_apart", "spike_ratio", "direction")
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*names).collect())

    gold = medallion.GoldFolder(spark, str(tmp_path / "gold"))
    checked = ingest.validate_signals(spark.createDataFrame([(v,) for v in values], "body string"))
    for kind, table in (("volume_spike", "volume_spikes"), ("momentum_signal", "momentum_signals")):
        gold.upsert(table, medallion.gold_from_signals(checked, kind, F.current_timestamp()))
    want = []
    for day in (date(2023, 11, 14), date(2023, 11, 15)):
        want += [tuple(r) for r in dashboard.multi_signal_confirmation(gold, day, CFG).select(*names).collect()]
    assert got == sorted(want) and len(got) > 20


def spark_ms(text):
    from datetime import datetime

    return int(datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp() * 1000)


def test_confirmation_state_is_dropped(spark, tmp_path):
    """What lies further back than band and lateness is no longer held."""
    cfg, feed = replace(CFG, confirm_ms=60_000), Lines(spark, tmp_path / "in")

    def momentum(ms):
        iso = spark.range(1).select(ms_to_iso(F.lit(ms).cast("bigint"))).first()[0]
        body = {
            "signal_type": "momentum_signal", "symbol": "a", "direction": "UP", "candles_in_direction": 3, "total_candles": 5, "oldest_open": 1.0,
            "latest_close": 1.0, "pct_change": 0.0, "window_start_ts": ms, "window_end_ts": ms, "detected_at": iso, "ml_anomaly_score": None,
        }
        return json.dumps(body)

    for k in range(6):
        feed.drop([momentum(1_700_000_000_000 + 1000 * (5_000 * k + i)) for i in range(50)])
    query = confirm.publish_confirmations(confirm.confirmations(feed.records(), cfg, "1 minute"), str(tmp_path / "o"), str(tmp_path / "c"), once=True)
    wait(query)
    held = sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"])
    assert held <= 4 * 50


# ---- replays ---------------------------------------------------------------------------------------


def test_replayed_trades_change_nothing(spark, rows, tmp_path):  # noqa: F811
    feed = Feed(spark, tmp_path / "in")
    pieces = cut(rows)
    for i, piece in enumerate(pieces):
        feed.drop(piece + piece[: len(piece) // 2])
        if i:  # a batch delivered again, with what came before it
            feed.drop(pieces[i - 1][-20:] + piece[-40:])
    for late in far(rows):
        feed.drop(late)
    own = jobs.distinct_trades(feed.trades(), CFG)
    out = str(tmp_path / "signals")
    wait(jobs.publish_signals(jobs.detect_signals(own, CFG), out, str(tmp_path / "c1"), once=True))
    got = sorted(_fields(json.loads(r["value"])) for r in spark.read.parquet(out).collect())
    batch = spark.createDataFrame(rows, SCHEMA)
    assert got == sorted(_fields(r.asDict()) for r in d.detect(batch, CFG).collect())

    names = ("s", "minute", "open", "high", "low", "close", "volume")
    bars = {tuple(plain(r[n]) for n in names) for r in streamed(jobs.stream_candles(jobs.distinct_trades(feed.trades(), CFG), CFG), tmp_path, "bars")}
    want = d.candles(batch, CFG.candle_ms).select(*names).collect()
    assert {b for b in bars if b[0] != "z"} == {tuple(map(plain, r)) for r in want}

    end = max(r[3] for r in rows)
    shown = ticks(streamed(jobs.detect_snapshots(jobs.distinct_trades(feed.trades(), CFG), CFG), tmp_path, "ticks"), end)
    snapshots = d.sector_snapshots(d.tick_states(batch, CFG.snapshot_ms), d.symbol_table(spark, ("a", "b", "c")), CFG)
    assert {k: v for k, v in shown.items() if k[1] != "z"} == ticks(snapshots.filter("trade_count > 0").collect(), end)

    wait(jobs.store_features(jobs.distinct_trades(feed.trades(), CFG), str(tmp_path / "f"), str(tmp_path / "c4"), once=True))
    stored = spark.read.parquet(str(tmp_path / "f")).filter("symbol <> 'z'")
    assert stored.agg(F.sum("batch_trade_count")).first()[0] == len(rows)


# ---- sessions --------------------------------------------------------------------------------------


GAP = 600_000


@pytest.fixture(scope="module")
def silences(rows):  # noqa: F811
    """The same trades with silences: one of all symbols, and some of single symbols."""
    out = []
    for s, p, v, t, seq in rows:
        shift = 3_000_000 * (seq >= 300) + 700_000 * (seq >= 600 and s == "a")
        out.append((s, p, v, t + shift, seq))
    out = [r for r in out if not (r[0] == "b" and 400 <= r[4] < 520)]
    return sorted(out, key=lambda r: (r[3], r[4]))


def test_signals_and_features_in_sessions(spark, silences, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    for i in range(0, len(silences), 90):
        feed.drop(silences[i : i + 90])
    found = streamed(jobs.detect_signals(feed.trades(), CFG, gap_ms=GAP, lateness="2 hours"), tmp_path, "signals")
    p = SessionPipeline(spark, spark.createDataFrame(silences, SCHEMA), "sessions", CFG, GAP)
    assert p.signals.agg(F.max("session_id")).first()[0] >= 2
    assert sorted(_fields(r.asDict()) for r in found) == sorted(_fields(r.asDict()) for r in p.signals.collect())
    by_key = {(r.symbol, r.t): r for r in p.features().collect()}
    for r in found:
        want = by_key[(r.symbol, r.trade_ts if r.trade_ts is not None else spark_ms(r.detected_at))]
        assert [r[c] for c in FEATURE_COLS] == pytest.approx([want[c] for c in FEATURE_COLS], abs=1e-6)
    whole = d.detect(spark.createDataFrame(silences, SCHEMA), CFG)
    assert sorted(_fields(r.asDict()) for r in found) != sorted(_fields(r.asDict()) for r in whole.collect())


def test_a_silent_symbol_holds_no_state(spark, silences, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    feed.drop(silences)
    for late in far(silences):
        feed.drop(late)
    feed.drop([("z", 1.0, 1.0, far(silences)[1][0][3] + 1, 20_000)])
    query = jobs._start(
        jobs.detect_signals(feed.trades(), CFG, gap_ms=GAP).writeStream.format("noop"), str(tmp_path / "c"), True
    )
    wait(query)
    progress = query.lastProgress["stateOperators"][0]
    kept = spark.read.format("statestore").option("path", str(tmp_path / "c")).option("stateVarName", "recent").load()
    assert {r.key.s for r in kept.select("key").collect()} == {"z"} and progress["operatorName"].startswith("transformWithState")


def test_snapshots_in_sessions(spark, silences, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    for i in range(0, len(silences), 150):
        feed.drop(silences[i : i + 150])
    for late in far(silences):
        feed.drop(late)
    end = max(r[3] for r in silences)
    shown = ticks(streamed(jobs.detect_snapshots(feed.trades(), CFG, gap_ms=GAP), tmp_path, "ticks"), end)
    p = SessionPipeline(spark, spark.createDataFrame(silences, SCHEMA), "session-ticks", replace(CFG, symbols=("a", "b", "c")), GAP)
    want = ticks(p.snapshots().collect(), end)
    # the stream reports a symbol from its first trade on
    first = {s: min(k[0] for k, v in want.items() if k[1] == s and v[3]) for s in "abc"}
    assert {k: v for k, v in shown.items() if k[1] != "z"} == {k: v for k, v in want.items() if k[0] >= first[k[1]]}
    assert any(v[3] == 0 for k, v in want.items() if k[0] > first[k[1]])
    with pytest.raises(ValueError):
        jobs.detect_snapshots(feed.trades(), CFG, gap_ms=CFG.snapshot_ms - 1)


def test_snapshots_in_short_sessions_of_the_batch(spark):
    """Sessions that begin and end within one tick: the later one is reported."""
    cfg = replace(CFG, symbols=("a", "b", "quiet"))
    trades = [("a", 1.0, 1.0, 1000, 0), ("a", 2.0, 1.0, 30_000, 1), ("a", 4.0, 1.0, 59_000, 2), ("b", 1.0, 2.0, 130_000, 3), ("a", 3.0, 1.0, 299_000, 4)]
    p = SessionPipeline(spark, spark.createDataFrame(trades, SCHEMA), "short", cfg, 10_000)
    got = {(r.symbol, r.snapshot_ms // 60_000): (r.open_price, r.last_price, r.trade_count) for r in p.snapshots().collect()}
    none = (None, None, 0)
    assert {k: v for k, v in got.items() if v != none} == {("a", 1): (4.0, 4.0, 1)}
    assert set(got) == {(s, t) for s in cfg.symbols for t in range(1, 5)}
    empty = SessionPipeline(spark, spark.createDataFrame([], SCHEMA), "none", cfg, 10_000)
    assert empty.snapshots().count() == 0 and empty.signals.count() == 0


# ---- restart ---------------------------------------------------------------------------------------


def test_restarted_snapshots_equal_those_that_ran_through(spark, rows, tmp_path):  # noqa: F811
    start = rows[450][3]
    before, after = [r for r in rows if r[3] < start], [r for r in rows if r[3] >= start]
    feed, through = Feed(spark, tmp_path / "in"), Feed(spark, tmp_path / "all")
    through.drop(before)
    for i in range(0, len(after), 100):
        feed.drop(after[i : i + 100])
        through.drop(after[i : i + 100])
    for late in far(rows):
        feed.drop(late)
        through.drop(late)
    end = max(r[3] for r in rows)
    warm = spark.createDataFrame(before + after[:5], SCHEMA)  # what lies after the start is not replayed
    stream = jobs.detect_snapshots(feed.trades(), CFG, warm=warm, start_ms=start)
    got = ticks(streamed(stream, tmp_path, "restarted"), end)
    want = ticks(streamed(jobs.detect_snapshots(through.trades(), CFG), tmp_path, "through"), end)
    assert got == {k: v for k, v in want.items() if k[0] >= start} and got
    with pytest.raises(ValueError):
        jobs.detect_snapshots(feed.trades(), CFG, warm=warm)


def test_warm_start_of_snapshots_equals_replay(spark, rows, tmp_path):  # noqa: F811
    """The lookback alone, as a restarted detector reads it."""
    start = rows[450][3]
    replayed = d.replay_from(spark.createDataFrame(rows, SCHEMA), start, CFG.warm_start_ms)
    feed = Feed(spark, tmp_path / "in")
    feed.drop([r for r in rows if r[3] >= start])
    for late in far(rows):
        feed.drop(late)
    end = max(r[3] for r in rows)
    got = ticks(streamed(jobs.detect_snapshots(feed.trades(), CFG, warm=replayed, start_ms=start), tmp_path, "warm"), end)
    want = Pipeline(spark, replayed, "warm", replace(CFG, symbols=("a", "b", "c"))).snapshots()
    want = ticks(want.filter(F.col("snapshot_ms") >= start).collect(), end)
    assert {k: v for k, v in got.items() if k[1] != "z"} == {k: v for k, v in want.items() if k in got}
    assert {k for k, v in want.items() if v[3]} <= set(got)


# ---- heartbeats ------------------------------------------------------------------------------------


def test_heartbeats_report_every_symbol(spark, rows, tmp_path):  # noqa: F811
    """Null prices before the first trade; from then on what the batch gives."""
    start, end = rows[0][3] - 600_000, max(r[3] for r in rows)
    beats = [(s, None, None, start + 10_000 * k, -(start + 10_000 * k)) for k in range((end - start) // 10_000 + 20) for s in CFG.symbols]
    merged = sorted([*beats, *rows], key=lambda r: r[3])
    feed = Feed(spark, tmp_path / "in")
    for i in range(0, len(merged), 700):
        feed.drop(merged[i : i + 700])
    trades, pulse = feed.trades().filter("p is not null"), feed.trades().filter("p is null")
    own = jobs.distinct_trades(jobs.with_heartbeat(trades, pulse), CFG)
    found = ticks(streamed(jobs.detect_snapshots(own, CFG), tmp_path, "ticks"), end)
    first = -(-start // CFG.snapshot_ms)
    assert min(k[0] for k in found) == first * CFG.snapshot_ms
    blank = (None, None, None, 0, 0.0, None, False)
    batch = ticks(d.sector_snapshots(d.tick_states(spark.createDataFrame(rows, SCHEMA), CFG.snapshot_ms), d.symbol_table(spark, CFG.symbols), CFG).collect(), end)
    assert {k: v for k, v in found.items() if k in batch} == {k: v for k, v in batch.items() if k in found}
    assert max(k[0] for k in found) >= end - 200_000
    early = {k: v for k, v in found.items() if k not in batch}
    assert len(early) >= 9 * len(CFG.symbols) and set(early.values()) == {blank}


def test_a_feed_without_trades_is_reported_by_the_clock(spark, tmp_path):
    cfg, feed = replace(CFG, snapshot_ms=2000), Feed(spark, tmp_path / "in")
    feed.drop([])
    own = jobs.with_heartbeat(feed.trades(), jobs.heartbeat(spark, cfg.symbols, 1))
    query = (
        jobs.detect_timed_snapshots(own, cfg).writeStream.format("memory").queryName("silent").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(processingTime="500 milliseconds").start()
    )
    try:
        limit = time.time() + 90
        while time.time() < limit and spark.table("silent").select("snapshot_ms").distinct().count() < 3:
            time.sleep(0.5)
    finally:
        query.stop()
    found = spark.table("silent").collect()
    spark.catalog.dropTempView("silent")
    assert {r.symbol for r in found} == set(cfg.symbols)
    assert {tuple(r[n] for n in NAMES) for r in found} == {(None, None, None, 0, 0.0, None, False)}
    assert len({r.snapshot_ms for r in found}) >= 3


def test_timed_snapshots_take_prices_by_arrival(spark):
    """Chunks of a batch in any order: the first price is that of the least number, the last that of the greatest."""
    import pandas as pd

    from tradeloom.streaming.processors import FOLD, TimedSnapshotProcessor

    class Value:
        def __init__(self):
            self.x = None

        def exists(self):
            return self.x is not None

        def get(self):
            return self.x

        def update(self, x):
            self.x = x

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            self.at = at

    class Times:
        def getCurrentProcessingTimeInMs(self):
            return 100_000

    p = TimedSnapshotProcessor(CFG)
    p.init(Handle())
    chunks = [[(5, 50.0), (6, 60.0)], [(1, 10.0), (9, 90.0)], [(3, 30.0)]]
    frames = [pd.DataFrame([("a", price, 1.0, 1000 * seq, seq) for seq, price in c], columns=["s", "p", "v", "t", "seq"]) for c in chunks]
    list(p.handleInputRows(("a",), iter(frames), Times()))
    list(p.handleInputRows(("a",), iter(frames[2:]), Times()))
    row = dict(zip((x.split()[0] for x in FOLD.split(", ")), p.session.get()))
    assert (row["open"], row["last"], row["n"], row["last_t"]) == (10.0, 90.0, 6, 9000)


# ---- arrival order through the archive -------------------------------------------------------------


def test_archived_trades_keep_their_order(spark, tmp_path):
    """Candles, features and a warm start from bronze equal those of the live trades, with many trades of one time."""
    from datetime import datetime, timedelta

    rng, out, t = random.Random(11), [], 1_700_000_000_000
    for i in range(600):
        t += rng.choice([0, 0, 0, 0, 2000, 20_000])
        out.append((rng.choice("ab"), float(rng.randrange(95, 106)), float(rng.randrange(1, 20)), t, i))
    feed = Lines(spark, tmp_path / "in")
    for i in range(0, len(out), 100):
        lines = [json.dumps({"s": s, "p": p, "v": v, "t": t, "c": ["x"]}) for s, p, v, t, _ in out[i : i + 100]]
        feed.drop([f"{n}|{line}" for n, line in enumerate(lines, i)])
    values = feed.records().select(
        F.substring_index("value", "|", -1).alias("value"), F.substring_index("value", "|", 1).cast("bigint").alias("offset")
    )
    lake, now = str(tmp_path / "bronze"), datetime(1970, 1, 1) + timedelta(milliseconds=t)
    wait(*jobs.archive_bronze(values, lake, str(tmp_path / "c"), once=True, seq=F.col("offset")))
    live = spark.createDataFrame(out, SCHEMA)
    archived = medallion.lookback_bronze(spark, lake, now, 1, arrival=True)
    assert sorted(map(tuple, archived.collect())) == sorted(out)
    assert all('"c"' in r.value for r in spark.read.text(lake).select("value").collect())
    assert medallion.read_bronze(spark, lake).columns == ["s", "p", "v", "t"]

    medallion.store_trades(archived, str(tmp_path / "trades"))
    stored = spark.read.parquet(str(tmp_path / "trades"))
    names = ("s", "minute", "open", "high", "low", "close", "volume")

    def bars(trades):
        return sorted(map(tuple, d.candles(trades, CFG.candle_ms).select(*names).collect()))

    assert bars(stored) == bars(archived) == bars(live)
    by_price = medallion.with_arrival(archived.drop("seq"))
    assert bars(by_price) != bars(live)  # which is why the number is kept

    def described(trades):
        rows = features.feature_windows(trades, 60_000).select("symbol", "bucket", "price_change_pct", "price_mean").collect()
        return sorted(tuple(map(plain, r)) for r in rows)

    assert described(stored) == described(live)
    recent = medallion.recent_bronze(spark, lake, now, 60_000, arrival=True)
    start = t - 60_000
    assert {tuple(r) for r in recent.collect()} == {r for r in out if r[3] >= start}


def test_lines_without_a_number_come_after_those_with_one(spark):
    rows = [("a", 2.0, 1.0, 5, 7), ("a", 1.0, 1.0, 5, None), ("a", 3.0, 1.0, 5, None), ("a", 1.0, 1.0, 5, None), ("b", 1.0, 1.0, 5, None)]
    got = medallion.with_arrival(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.s, r.seq, r.p) for r in got) == [("a", 7, 2.0), ("a", 8, 1.0), ("a", 9, 1.0), ("a", 10, 3.0), ("b", 0, 1.0)]


def test_a_line_keeps_what_it_holds(spark):
    lines = spark.createDataFrame([('{"s":"a","x":{"y":1}} ', 3), ('{"s":"}"}', 4)], "value string, seq long")
    got = [r[0] for r in lines.select(medallion.with_number(F.col("value"), F.col("seq"))).collect()]
    assert got == ['{"s":"a","x":{"y":1},"seq":3}', '{"s":"}","seq":4}']
