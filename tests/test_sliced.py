"""The sliced stream gives what the batch operators give, and spreads one symbol over tasks."""

import json

import pytest
from pyspark.sql import functions as F

from test_live import NAMES, far, plain
from test_streaming import CFG, SCHEMA, Feed, _fields, cut, rows, wait  # noqa: F401
from tradeloom.functions.columns import ms_to_iso
from tradeloom.operators import detectors as d
from tradeloom.operators import features, iforest
from tradeloom.streaming import sliced


def test_sliced_signals_equal_batch_across_restarts(spark, rows, tmp_path):  # noqa: F811
    trades = spark.createDataFrame(rows, SCHEMA)
    model = iforest.IsolationForest(key=("symbol", "bucket"), numTrees=5).fit(features.feature_windows(trades, 60_000))
    feed, out, state = Feed(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    for piece in cut(rows, (400, 500)):
        feed.drop(piece)
        wait(sliced.publish_sliced_signals(feed.trades(), CFG, out, state, str(tmp_path / "c"), once=True, model=model))
    sent = [json.loads(r["value"]) for r in spark.read.parquet(out).collect()]
    found = d.detect(trades, CFG)
    assert sorted(map(_fields, sent)) == sorted(_fields(r.asDict()) for r in found.collect())
    recent = features.feature_recent(trades, CFG.recent_trades, 300_000, found)
    scored = iforest.score_signals(found, recent, model).collect()
    want = {(r.signal_type, r.symbol, r.detected_at): r.ml_anomaly_score for r in scored}
    got = {(v["signal_type"], v["symbol"], v["detected_at"]): v["ml_anomaly_score"] for v in sent}
    assert got == pytest.approx(want) and None not in got.values()
    tail = spark.read.parquet(str(tmp_path / "state" / "batch=1" / "tail"))
    assert tail.count() < len(rows) and {r.s for r in tail.collect()} == {"a", "b", "c"}


def test_a_batch_that_runs_again_changes_nothing(spark, rows, tmp_path):  # noqa: F811
    one = sliced.SlicedSignals(spark, CFG, str(tmp_path / "s"))
    frames = [spark.createDataFrame(piece, SCHEMA) for piece in (rows[:300], rows[300:600])]
    names = ("signal_type", "symbol", "trade_ts", "seq")
    one.run(frames[0], 0)
    one.state.finish(0)
    first = sorted(map(tuple, one.run(frames[1], 1).select(*names).collect()))  # not finished: the job fails here
    again = sliced.SlicedSignals(spark, CFG, str(tmp_path / "s"))
    assert sorted(map(tuple, again.run(frames[1], 1).select(*names).collect())) == first and first


def test_one_symbol_runs_in_several_tasks(spark, rows, tmp_path):  # noqa: F811
    """All trades in one symbol: its windows are worked on by more than one task, and the result is that of the batch."""
    own = [("a", *r[1:]) for r in rows]
    trades = spark.createDataFrame(own, SCHEMA)
    rolled = d.rolling_stats(trades, CFG.volume_window_ms).withColumn("task", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rolled.select("task").distinct().count() > 1
        ticks = d.tick_states(trades, CFG.snapshot_ms).withColumn("task", F.spark_partition_id())
        assert ticks.select("task").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    detector = sliced.SlicedSignals(spark, CFG, str(tmp_path / "s"))
    names = ("signal_type", "symbol", "trade_ts", "seq")
    got = []
    for k, (a, b) in enumerate(((0, 400), (400, 900))):
        got += map(tuple, detector.run(spark.createDataFrame(own[a:b], SCHEMA), k).select(*names).collect())
        detector.state.finish(k)
    assert sorted(got) == sorted(map(tuple, d.detect(trades, CFG).select(*names).collect()))


def test_sliced_snapshots_equal_batch(spark, rows, tmp_path):  # noqa: F811
    feed, out = Feed(spark, tmp_path / "in"), str(tmp_path / "out")
    for piece in [*cut(rows, (400, 500)), *far(rows)]:
        feed.drop(piece)
    end = max(r[3] for r in rows)
    wait(sliced.publish_sliced_snapshots(feed.trades(), CFG, out, str(tmp_path / "state"), str(tmp_path / "c"), once=True))
    records = [json.loads(r["value"]) for r in spark.read.parquet(out).collect()]
    got = {(r["snapshot_ts"], e["symbol"]): tuple(plain(e[n]) for n in NAMES) for r in records for e in r["symbols"]}
    assert len(got) == sum(len(r["symbols"]) for r in records)
    batch = d.sector_snapshots(d.tick_states(spark.createDataFrame(rows, SCHEMA), CFG.snapshot_ms), d.symbol_table(spark, CFG.symbols), CFG)
    shown = batch.filter(F.col("snapshot_ms") <= end).select(ms_to_iso(F.col("snapshot_ms")).alias("at"), "symbol", *NAMES).collect()
    want = {(r["at"], r["symbol"]): tuple(plain(r[n]) for n in NAMES) for r in shown}
    last = max(k[0] for k in want)
    assert {k: v for k, v in got.items() if k[0] <= last and k[1] != "z"} == want


def test_sliced_snapshots_drop_what_is_too_late(spark, tmp_path):
    one = sliced.SlicedSnapshots(spark, CFG, str(tmp_path / "s"), 60_000)

    def run(k, *trades):
        rows = one.run(spark.createDataFrame([("a", p, 1.0, t, i) for i, (p, t) in enumerate(trades)], SCHEMA), k)
        found = {(r.snapshot_ms // 60_000): (r.open_price, r.last_price, r.trade_count) for r in rows.collect()}
        one.state.finish(k)
        return found

    assert run(0, (1.0, 30_000)) == {}
    assert run(1, (2.0, 100_000), (0.5, 10_000)) == {}  # an earlier trade, not too late
    assert run(2, (3.0, 200_000)) == {1: (0.5, 1.0, 2), 2: (0.5, 2.0, 3)}
    assert run(3, (9.0, 139_000), (4.0, 310_000)) == {3: (0.5, 2.0, 3), 4: (0.5, 3.0, 4)}
    assert run(4) == {}
    assert run(5, (5.0, 86_400_000 + 61_000))[1440] == (0.5, 4.0, 5)  # over midnight
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["batch=4", "batch=5"]  # older state is dropped
