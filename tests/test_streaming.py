"""Streams give what the batch operators give, however the input is cut and wherever a job is restarted."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tradeloom.config import Settings
from tradeloom.functions.columns import ms_to_iso
from tradeloom.operators import detectors as d
from tradeloom.plans.gold import Pipeline
from tradeloom.schemas import TRADE
from tradeloom.sources import medallion
from tradeloom.streaming import jobs

CFG = Settings(symbols=("a", "b", "c", "quiet"))
SCHEMA = "s string, p double, v double, t bigint, seq bigint"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out, t = [], 1_700_000_000_000
    for i in range(900):
        t += rng.choice([0, 0, 1000, 3000, 9000, 30_000])
        price = round(100 + rng.gauss(0, 1) + 15 * (rng.random() < 0.02), 2)
        out.append((rng.choice("aaabc"), price, round(rng.expovariate(0.1), 2), t, i))
    return out


class Feed:
    """A folder that files are dropped into; each run of a job takes what is new."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path), 0
        path.mkdir(parents=True)

    def drop(self, rows):
        self.n += 1
        name = f"{self.path}/part-{self.n:04d}.json"
        with open(name, "w") as f:
            f.writelines(json.dumps(dict(zip(("s", "p", "v", "t", "seq"), r))) + "\n" for r in rows)
        # The file source takes files by age.
        os.utime(name, (1_600_000_000 + self.n, 1_600_000_000 + self.n))

    def trades(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(self.path)


def cut(rows, sizes=(1, 50, 200, 7, 300, 342)):
    out, at = [], 0
    for n in sizes:
        out.append(rows[at : at + n])
        at += n
    assert at == len(rows)
    return out


def wait(*queries):
    for q in queries:
        assert q.awaitTermination(120)


def test_signals_equal_batch_across_restarts(spark, rows, tmp_path):
    feed, out, check = Feed(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    pieces = cut(rows)
    for part in (pieces[:2], pieces[2:5], pieces[5:]):
        for piece in part:
            feed.drop(piece)
        wait(jobs.publish_signals(jobs.detect_signals(feed.trades(), CFG), out, check, once=True))
    streamed = spark.read.parquet(out)
    got = sorted(_fields(json.loads(r["value"])) for r in streamed.collect())

    pipe = Pipeline(spark, spark.createDataFrame(rows, SCHEMA), "stream-batch", CFG)
    batch = d.unify(pipe.volume(), pipe.momentum(), pipe.volatility())
    want = sorted(_fields(r.asDict()) for r in batch.collect())
    assert got == want
    assert {g[0] for g in got} == {"volume_spike", "volatility_spike", "momentum_signal"}


def _fields(v):
    names = ("signal_type", "symbol", "detected_at", "price", "spike_ratio", "z_score", "std_dev", "pct_change", "avg_volume",
             "direction", "candles_in_direction", "window_trade_count", "window_start_ts")
    return tuple(str(v.get(n)) for n in names)


def test_snapshots_equal_batch(spark, rows, tmp_path):
    feed, out, check = Feed(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    for piece in cut(rows):
        feed.drop(piece)
    snapshots = jobs.detect_snapshots(feed.trades(), CFG, "0 seconds")
    wait(jobs.publish_snapshots(snapshots, CFG.symbols, out, check, once=True))
    records = [json.loads(r["value"]) for r in spark.read.parquet(out).collect()]
    assert all([e["symbol"] for e in r["symbols"]] == sorted(CFG.symbols) for r in records)
    names = ("last_price", "open_price", "pct_change", "trade_count", "last_trade_ts", "is_stale")
    got = {(r["snapshot_ts"], e["symbol"], *(e[n] for n in names)) for r in records for e in r["symbols"]}
    batch = d.sector_snapshots(
        d.tick_states(spark.createDataFrame(rows, SCHEMA), CFG.snapshot_ms), d.symbol_table(spark, CFG.symbols), CFG
    )
    want = {tuple(r) for r in batch.select(ms_to_iso(F.col("snapshot_ms")), "symbol", *names).collect()}
    assert got == want


def test_candles_equal_batch(spark, rows, tmp_path):
    feed, out = Feed(spark, tmp_path / "in"), str(tmp_path / "out")
    far = [("z", 1.0, 1.0, rows[-1][3] + 10_000_000, 10_000)]
    for piece in [*cut(rows), far]:
        feed.drop(piece)
    stream = jobs.stream_candles(feed.trades(), CFG)
    wait(jobs._start(stream.writeStream.format("parquet"), str(tmp_path / "check"), True, path=out))
    names = ("s", "minute", "open", "high", "low", "close")
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*names).collect())
    want = sorted(tuple(r) for r in d.candles(spark.createDataFrame(rows, SCHEMA), CFG.candle_ms).select(*names).collect())
    assert got == want


def test_frames_to_raw_to_bronze(spark, tmp_path):
    frames, raw, lake = tmp_path / "frames", str(tmp_path / "raw"), str(tmp_path / "bronze")
    frames.mkdir()
    now = 1_700_000_000_000
    good = {"s": "a", "p": 1.5, "v": 2, "t": now, "c": ["1"]}
    lines = [
        json.dumps({"type": "trade", "data": [good, good | {"s": "x"}, good | {"p": 0}, good | {"t": now - 60_001}]}),
        json.dumps({"type": "trade", "data": [good | {"t": now - 60_000, "s": "b"}]}),
        json.dumps({"type": "ping"}),
        "not json",
    ]
    (frames / "f.txt").write_text("\n".join(lines))
    text = jobs.source(spark, "text", {}, str(frames))
    trades = jobs.trades_from_frames(text, CFG, F.lit(now))
    wait(jobs.publish_trades(trades, raw, str(tmp_path / "c1"), once=True))
    sent = [json.loads(r.value) for r in spark.read.schema("key string, value string").json(raw).collect()]
    assert sorted((x["s"], x["t"]) for x in sent) == [("a", now), ("b", now - 60_000)]
    assert set(sent[0]) == {"s", "p", "v", "t"}

    values = spark.readStream.schema("key string, value string").json(raw)
    wait(*jobs.archive_bronze(values, lake, str(tmp_path / "c2"), once=True))
    assert (tmp_path / "bronze" / "year=2023" / "month=11" / "day=14" / "hour=22").is_dir()
    assert medallion.read_bronze(spark, lake).count() == 2

    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "b.txt").write_text("{oops\n" + json.dumps({"s": "a", "p": 1, "v": 1, "t": now}))
    other = str(tmp_path / "other")
    wait(*jobs.archive_bronze(jobs.source(spark, "text", {}, str(broken)), other, str(tmp_path / "c3"), once=True))
    assert medallion.read_bronze(spark, other).count() == 1
    assert [r.value for r in spark.read.text(f"{other}_errors").collect()] == ["{oops"]


def test_raw_values(spark):
    rows = [('{"s":"a","p":1,"v":2,"t":3}', 7), ("junk", 8), ('{"p":1}', 9)]
    found = jobs.trades_from_values(spark.createDataFrame(rows, "value string, offset long"), F.col("offset")).collect()
    assert [(r.s, r.t, r.seq) for r in found] == [("a", 3, 7)]
    with pytest.raises(TypeError):
        jobs.trades_from_values(spark.createDataFrame(rows, "value string, offset long"))
    assert TRADE.startswith("s string")


def test_features_are_replaced_on_replay(spark, rows, tmp_path):
    feed, out = Feed(spark, tmp_path / "in"), str(tmp_path / "out")
    feed.drop(rows[:300])
    feed.drop(rows[300:])
    wait(jobs.store_features(feed.trades(), out, str(tmp_path / "c1"), once=True))
    first = spark.read.parquet(out).count()
    assert first == 6
    assert spark.read.parquet(out).agg(F.sum("batch_trade_count")).first()[0] == len(rows)
    # A new checkpoint reads everything again, as a replay would.
    wait(jobs.store_features(feed.trades(), out, str(tmp_path / "c2"), once=True))
    assert spark.read.parquet(out).count() == first


def test_signals_to_silver_and_gold_twice(spark, rows, tmp_path):
    feed, signals, lake = Feed(spark, tmp_path / "in"), str(tmp_path / "signals"), str(tmp_path / "lake")
    for piece in cut(rows):
        feed.drop(piece)
    wait(
        jobs.publish_signals(jobs.detect_signals(feed.trades(), CFG), f"{signals}/a", str(tmp_path / "c1"), once=True),
        jobs.publish_snapshots(jobs.detect_snapshots(feed.trades(), CFG), CFG.symbols, f"{signals}/b", str(tmp_path / "c2"), once=True),
    )
    spark.createDataFrame([("x", "{broken", 0), ("x", '{"signal_type":"mystery"}', 0)], "key string, value string, batch_id int").write.parquet(
        f"{signals}/c"
    )
    pipe = Pipeline(spark, spark.createDataFrame(rows, SCHEMA), "stream-gold", CFG)
    counts = []
    for run in ("c3", "c4"):
        for part in "abc":
            values = spark.readStream.schema("key string, value string, batch_id int").parquet(f"{signals}/{part}")
            wait(jobs.load_signals(values, f"{lake}/{part}", str(tmp_path / run / part), once=True))
        a, b = (medallion.GoldFolder(spark, f"{lake}/{part}/gold") for part in "ab")
        counts.append([a.volume_spikes.count(), a.momentum_signals.count(), a.volatility_spikes.count(), b.sector_snapshots.count()])
        assert sorted(r.error for r in spark.read.parquet(f"{lake}/c/quarantine").collect()) == ["bad_json", "unknown_type"]
        assert jobs.latest_silver(spark, f"{lake}/a").count() == sum(counts[-1][:3])
    assert counts[0] == counts[1]
    assert counts[0][:3] == [pipe.volume().count(), pipe.momentum().count(), pipe.volatility().count()]
    names = ("detected_at", "symbol", "spike_ratio", "window_trade_count")
    got = sorted(tuple(r) for r in a.volume_spikes.select(*names).collect())
    assert got == sorted(tuple(r) for r in pipe.volume_spikes.select(*names).collect())


def test_scores_in_the_stream_equal_batch(spark, rows, tmp_path):
    from tradeloom.operators import features, iforest

    trades = spark.createDataFrame(rows, SCHEMA)
    model = iforest.IsolationForest(key=("symbol", "bucket"), numTrees=10).fit(features.feature_windows(trades, 60_000))
    feed, out = Feed(spark, tmp_path / "in"), str(tmp_path / "out")
    for piece in cut(rows):
        feed.drop(piece)
    signals = jobs.detect_signals(feed.trades(), CFG)
    wait(jobs.publish_signals(signals, out, str(tmp_path / "check"), once=True, model=model))
    sent = [json.loads(r["value"]) for r in spark.read.parquet(out).collect()]
    got = {(v["signal_type"], v["symbol"], v["detected_at"]): v["ml_anomaly_score"] for v in sent}
    found = d.detect(trades, CFG)
    scored = iforest.score_signals(found, features.feature_recent(trades, CFG.recent_trades, 300_000, found), model).collect()
    want = {(r.signal_type, r.symbol, r.detected_at): r.ml_anomaly_score for r in scored}
    assert want and None not in want.values()
    assert got == pytest.approx(want)


def _ticks(spark, out, upto):
    names = ("last_price", "open_price", "pct_change", "trade_count", "total_volume", "last_trade_ts", "is_stale")
    records = [json.loads(r["value"]) for r in spark.read.parquet(out).collect()]
    found = {}
    for r in records:
        for e in r["symbols"]:
            if r["snapshot_ts"] <= upto and e["trade_count"]:
                key = (r["snapshot_ts"], e["symbol"])
                assert key not in found
                found[key] = tuple(round(e[n], 6) if isinstance(e[n], float) else e[n] for n in names)
    return found, names


def test_late_trades_count_in_snapshots(spark, rows, tmp_path):
    """Trades up to a minute late and out of order, across batches: the stream gives what the batch gives."""
    rng = random.Random(8)
    arriving = sorted(rows, key=lambda r: r[3] + rng.randrange(0, 59_000))
    arriving = [(*r[:4], i) for i, r in enumerate(arriving)]
    feed, out = Feed(spark, tmp_path / "in"), str(tmp_path / "out")
    for piece in cut(arriving):
        feed.drop(piece)
    end = max(r[3] for r in rows)
    for k in (1, 2):
        feed.drop([("z", 1.0, 1.0, end + k * 10_000_000, 10_000 + k)])
    snapshots = jobs.detect_snapshots(feed.trades(), CFG)
    wait(jobs.publish_snapshots(snapshots, CFG.symbols, out, str(tmp_path / "check"), once=True))
    batch = d.sector_snapshots(
        d.tick_states(spark.createDataFrame(arriving, SCHEMA), CFG.snapshot_ms), d.symbol_table(spark, CFG.symbols), CFG
    )
    got, names = _ticks(spark, out, spark.range(1).select(ms_to_iso(F.lit(end).cast("bigint"))).first()[0])
    got = {k: v for k, v in got.items() if k[1] != "z"}
    rows_ = batch.filter("trade_count > 0").select(ms_to_iso(F.col("snapshot_ms")).alias("at"), "symbol", *names).collect()
    want = {(r.at, r.symbol): tuple(round(x, 6) if isinstance(x, float) else x for x in tuple(r)[2:]) for r in rows_}
    assert got == want


def test_snapshots_by_the_clock_of_a_silent_feed(spark, tmp_path):
    import time
    from dataclasses import replace

    feed = Feed(spark, tmp_path / "in")
    now = int(time.time() * 1000)
    feed.drop([("a", 10.0, 1.0, now - 5000, 0), ("a", 11.0, 2.0, now - 4000, 1)])
    stream = jobs.detect_timed_snapshots(feed.trades(), replace(CFG, snapshot_ms=1000))
    query = (
        stream.writeStream.format("memory").queryName("timed").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(processingTime="500 milliseconds").start()
    )
    try:
        limit = time.time() + 90
        while time.time() < limit and spark.table("timed").count() < 3:
            time.sleep(0.5)
    finally:
        query.stop()
    found = spark.table("timed").orderBy("snapshot_ms").collect()
    spark.catalog.dropTempView("timed")
    assert len(found) >= 3 and len({r.snapshot_ms for r in found}) == len(found)
    assert all(r.snapshot_ms % 1000 == 0 for r in found)
    assert {(r.symbol, r.open_price, r.last_price, r.pct_change, r.trade_count, r.total_volume) for r in found} == {
        ("a", 10.0, 11.0, 10.0, 2, 3.0)
    }


def test_warm_start_of_the_stream_equals_replay(spark, rows, tmp_path):
    start = rows[450][3]
    before = [r for r in rows if start - CFG.warm_start_ms <= r[3] < start]
    feed, out = Feed(spark, tmp_path / "in"), str(tmp_path / "out")
    feed.drop([r for r in rows if r[3] >= start])
    stream = jobs.detect_signals(feed.trades(), CFG, warm=spark.createDataFrame(before, SCHEMA))
    wait(jobs.publish_signals(stream, out, str(tmp_path / "check"), once=True))
    got = sorted(_fields(json.loads(r["value"])) for r in spark.read.parquet(out).collect())
    batch = d.warm_start(spark.createDataFrame(rows, SCHEMA), CFG, start)
    assert got == sorted(_fields(r.asDict()) for r in batch.collect())
    cold = d.detect(spark.createDataFrame([r for r in rows if r[3] >= start], SCHEMA), CFG)
    assert got != sorted(_fields(r.asDict()) for r in cold.collect())


def test_detectors_plugged_into_the_stream(spark, rows, tmp_path):
    def every_tenth(symbol, t, p, v, state):
        """A detector of one's own: each tenth trade of a symbol."""
        seen = state.get("seen", 0)
        state["seen"] = seen + len(t)
        return [{"row": i, "price": float(p[i])} for i in range(len(t)) if (seen + i + 1) % 10 == 0]

    feed, out = Feed(spark, tmp_path / "in"), str(tmp_path / "out")
    for piece in cut(rows):
        feed.drop(piece)
    stream = jobs.detect_signals(feed.trades(), CFG, plugins={"tenth": every_tenth})
    wait(jobs._start(stream.writeStream.format("parquet"), str(tmp_path / "check"), True, path=out))
    got = spark.read.parquet(out).filter("signal_type = 'tenth'").select("symbol", "trade_ts", "price").collect()
    want = []
    for s in "abc":
        own = [r for r in rows if r[0] == s]
        want += [(s, r[3], r[1]) for i, r in enumerate(own) if i % 10 == 9]
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_failing_model_leaves_scores_null(spark, rows, tmp_path):
    from tradeloom.operators import evaluation, features, iforest

    class Broken(iforest.IsolationForestModel):
        def _transform(self, dataset):
            raise RuntimeError("no model today")

    trades = spark.createDataFrame(rows, SCHEMA)
    model = iforest.IsolationForest(key=("symbol", "bucket"), numTrees=5).fit(features.feature_windows(trades, 60_000))
    registry = evaluation.ModelRegistry(spark, str(tmp_path / "versions"))
    feed, sent = Feed(spark, tmp_path / "in"), {}
    for piece in cut(rows):
        feed.drop(piece)

    def run(name, scorer):
        signals = jobs.detect_signals(feed.trades(), CFG)
        wait(jobs.publish_signals(signals, str(tmp_path / name), str(tmp_path / f"c{name}"), once=True, model=scorer))
        values = [json.loads(r["value"]) for r in spark.read.parquet(str(tmp_path / name)).collect()]
        return [v.get("ml_anomaly_score") for v in values]

    broken = Broken(model.nodes, model.low, model.high)
    assert set(run("broken", broken)) == {None}
    assert set(run("none", registry)) == {None}
    model.save(spark, str(tmp_path / "model"))
    from datetime import datetime

    version = registry.register(str(tmp_path / "model"), 0.1, datetime(2024, 1, 1))
    registry.approve(version, datetime(2024, 1, 2))
    scores = run("approved", registry)
    assert scores and None not in scores


def test_consumers_start_at_the_newest_record():
    assert jobs.source_options("kafka", {"subscribe": "raw"}) == {"subscribe": "raw", "startingOffsets": "latest"}
    assert jobs.source_options("kafka", {"startingOffsets": "earliest"}) == {"startingOffsets": "earliest"}
    assert jobs.source_options("text", {"maxFilesPerTrigger": "1"}) == {"maxFilesPerTrigger": "1"}
