"""Every registered query: ``name -> callable(spark, sf_dir)``."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.columns import half_even, ms_to_iso, ms_to_ts, ts_literal
from tradeloom.operators import detectors as d
from tradeloom.operators import evaluation, features, iforest
from tradeloom.operators.cooldown import cooldown_thin
from tradeloom.plans import dashboard as q
from tradeloom.plans import presentation as show
from tradeloom.plans import training
from tradeloom.plans.gold import Pipeline, SessionPipeline
from tradeloom.registry.inputs import AS_OF, CFG, DAY, events, once, pipeline, price, stand_in_score, trades
from tradeloom.schemas import FEATURE_COLS
from tradeloom.sources import ingest, medallion

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(rows: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Cut the last bits of sums, which depend on the order of addition."""
    return rows.withColumns({c: half_even(F.col(c), digits) for c in columns})


# ---- ingest ----------------------------------------------------------------------------------------


def wire_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of up to five trades, with one defect of each kind in every fifty events."""
    e = events(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 50).alias("d"),
        F.expr("event_id div 5").alias("frame"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("at"),
        "event_type",
        "value",
        price().alias("price"),
    )
    entry = F.struct(
        "seq",
        "d",
        F.when(F.col("d") == 1, "nobody").otherwise(F.col("event_type")).alias("s"),
        F.when(F.col("d") == 3, 0.0).when(F.col("d") == 4, -F.col("price")).when(F.col("d") != 2, F.col("price")).alias("p"),
        F.when(F.col("d") == 6, -1.0).when(F.col("d") != 5, F.col("value")).alias("v"),
    )
    grouped = e.groupBy("frame").agg(
        F.max("at").alias("received"),
        F.array_sort(F.collect_list(F.when(~F.col("d").isin(10, 11, 12), entry))).alias("entries"),
        F.collect_list(F.when(F.col("d").isin(10, 11, 12), F.col("d"))).alias("others"),
    )
    sent = (
        lambda x, received: F.when(x["d"] == 8, received - 60_001)
        .when(x["d"] == 9, received - 60_000)
        .when(x["d"] != 7, received - 1000 * (x["seq"] % 5))
    )
    data = F.transform(
        "entries",
        lambda x: F.struct(
            x["s"].alias("s"),
            x["p"].alias("p"),
            x["v"].alias("v"),
            sent(x, F.col("received")).alias("t"),
            F.array(F.lit("1")).alias("c"),
        ),
    )
    trade_frame = F.when(F.size("entries") > 0, F.to_json(F.struct(F.lit("trade").alias("type"), data.alias("data"))))
    odd = F.transform(
        "others",
        lambda x: F.when(x == 10, F.lit("not json {")).when(x == 11, F.lit('{"type":"ping"}')).otherwise(F.lit('{"type":"news","data":[]}')),
    )
    return grouped.select(
        "frame", "received", F.explode(F.filter(F.concat(F.array(trade_frame), odd), lambda x: x.isNotNull())).alias("value")
    )


def _wire_trades(spark, sf_dir) -> DataFrame:
    return ingest.parse_frames(wire_frames(spark, sf_dir), keep=("frame", "received"))


@query
def frame_parse(spark, sf_dir):
    """Trades out of frames."""
    return _wire_trades(spark, sf_dir).drop("received").withColumn("t", F.coalesce("t", F.lit(-1)))


@query
def valid_trades(spark, sf_dir):
    """Trades that pass every rule."""
    kept = ingest.valid_trades(_wire_trades(spark, sf_dir), CFG.symbols, F.col("received"), CFG.ingest_staleness)
    return kept.select("s", "p", "v", "t")


@query
def reject_report(spark, sf_dir):
    """Refused trades by symbol and reason."""
    return ingest.reject_report(_wire_trades(spark, sf_dir), CFG.symbols, F.col("received"), CFG.ingest_staleness)


@query
def frame_type_counts(spark, sf_dir):
    """Frames by type."""
    return ingest.frame_type_counts(wire_frames(spark, sf_dir))


@query
def envelope_decode(spark, sf_dir):
    """base64 records; two of every fifty are broken."""
    text = F.to_json(F.struct("s", "p", "v", "t"))
    data = (
        F.when(F.col("seq") % 50 == 10, "%%%").when(F.col("seq") % 50 == 11, F.base64(F.lit("oops"))).otherwise(F.base64(text))
    )
    records = trades(spark, sf_dir).select(
        F.to_json(F.struct(F.struct(data.alias("data")).alias("kinesis"))).alias("value")
    )
    return ingest.parse_trades(ingest.decode_envelopes(records))


def wire_signals(spark: SparkSession, sf_dir: str, bump: float = 0.0) -> DataFrame:
    """Encoded signals with the defects listed in ``oracle.SIGNAL_ERROR``; ``bump`` alters the price shown."""
    p = pipeline(spark, sf_dir)
    unified = stand_in_score(_signals(p)).withColumns(
        {"price": F.col("price") + bump, "latest_close": F.col("latest_close") + bump}
    )
    encoded = ingest.encode_signals(unified, keep=("symbol", "trade_ts", "seq")).withColumnsRenamed(
        {"key": "kind", "value": "body"}
    )
    seq, body = F.col("seq"), F.col("body")
    return encoded.withColumn(
        "body",
        F.when(seq % 13 == 0, F.lit('{"broken'))
        .when(seq % 11 == 0, F.regexp_replace(body, '"signal_type":"[a-z_]+"', '"signal_type":"mystery"'))
        .when((seq % 7 == 0) & (F.col("kind") == "momentum_signal"), F.regexp_replace(body, '"direction":"[A-Z]+"', '"direction":"SIDEWAYS"'))
        .when(seq % 7 == 0, F.regexp_replace(body, '"price":[-0-9.E]+', '"price":null'))
        .when(seq % 17 == 0, F.regexp_replace(body, ',"ml_anomaly_score":(null|[-0-9.E]+)', ""))
        .otherwise(body),
    )


def _signals(p) -> DataFrame:
    """All signals with every field and their arrival number, from the stage tables."""
    return p.stage.table("signals", lambda: d.unify(p.volume(), p.momentum(), p.volatility()))


@query
def signal_validate(spark, sf_dir):
    """Each record with the field that spoils it."""
    return ingest.validate_signals(wire_signals(spark, sf_dir)).select("kind", "symbol", "trade_ts", "error")


@query
def session_filter(spark, sf_dir):
    """Trades within exchange hours."""
    return trades(spark, sf_dir).filter(ingest.in_session(F.col("t"))).select("s", "p", "v", "t")


def _bronze(spark: SparkSession, sf_dir: str, numbered: bool = False) -> str:
    def write(path: str) -> None:
        rows = trades(spark, sf_dir)
        text = F.to_json(F.struct("s", "p", "v", "t"))
        text = medallion.with_number(text, F.col("seq")) if numbered else text
        junk = F.when(F.col("seq") % 50 == 10, F.lit("{broken")).when(F.col("seq") % 50 == 11, F.lit(""))
        lines = rows.select("t", F.explode(F.filter(F.array(text, junk), lambda x: x.isNotNull())).alias("value"))
        medallion.write_bronze(lines, F.timestamp_millis("t"), path, "overwrite", spread=1)

    return pipeline(spark, sf_dir).stage.folder("numbered-bronze" if numbered else "bronze", write)


@query
def bronze_recent_scan(spark, sf_dir):
    """What a restart replays."""
    return medallion.recent_bronze(spark, _bronze(spark, sf_dir), AS_OF, CFG.warm_start_ms)


@query
def bronze_lookback_scan(spark, sf_dir):
    """What the feature job reads."""
    return medallion.lookback_bronze(spark, _bronze(spark, sf_dir), AS_OF, 14)


@query
def bronze_candles(spark, sf_dir):
    """Candles of the archive's last days, in the order in which its trades arrived."""
    archived = medallion.lookback_bronze(spark, _bronze(spark, sf_dir, True), AS_OF, 14, arrival=True)
    return rounded(d.candles(medallion.with_arrival(archived), CFG.candle_ms), "volume")


@query
def retention_expired(spark, sf_dir):
    """Day partitions past their retention."""
    days = trades(spark, sf_dir).select(F.to_date(F.timestamp_millis("t")).alias("date"))
    layers = [medallion.expired_partitions(days, layer, date(2024, 4, 10)) for layer in ("bronze", "silver", "features")]
    return layers[0].unionByName(layers[1]).unionByName(layers[2]).withColumn("date", F.col("date").cast("string"))


# ---- medallion -------------------------------------------------------------------------------------


def _shown(body: str = "body") -> Column:
    return F.coalesce(F.get_json_object(body, "$.price"), F.get_json_object(body, "$.latest_close")).cast("double")


@query
def silver_route(spark, sf_dir):
    """Archive objects after a replay of every third record with a new price."""
    first = wire_signals(spark, sf_dir).withColumn("arrival", F.col("seq"))
    again = (
        wire_signals(spark, sf_dir, 1.0).filter(F.col("seq") % 3 == 0).withColumn("arrival", F.col("seq") + 1_000_000_000)
    )
    routed = medallion.route_silver(ingest.validate_signals(first.unionByName(again)), "arrival")
    day = F.col("date").cast("string").alias("date")
    return routed.select("path", "signal_type", day, "arrival", _shown().alias("shown"))


@query
def silver_read_typed(spark, sf_dir):
    """Archive objects, one in five under a foreign prefix and one in five under another kind's."""
    stamp = ms_to_iso(F.col("trade_ts"))
    path = medallion.silver_path(F.col("kind"), F.col("symbol"), stamp)
    objects = wire_signals(spark, sf_dir).withColumn(
        "path",
        F.when(F.col("seq") % 5 == 0, F.regexp_replace(path, "^silver/[a-z]+/", "silver/foo/"))
        .when(F.col("seq") % 5 == 1, F.regexp_replace(path, "^silver/[a-z]+/", "silver/sector/"))
        .otherwise(path),
    )
    return medallion.read_silver(objects).select("signal_type", "symbol", "trade_ts", _shown().alias("shown"))


def _upserted(rows: DataFrame, key_time: str, is_old: Column, value: str) -> DataFrame:
    """Half of the rows are there already; all arrive twice, the second copy later and with another origin."""
    rows = rows.select(key_time, "symbol", value, is_old.alias("_old"))
    old = rows.filter("_old").withColumn("origin", F.lit("old")).withColumn("processed_at", ts_literal(AS_OF))
    copies = [
        rows.withColumn("origin", F.lit(o)).withColumn("processed_at", ts_literal(AS_OF + timedelta(hours=h)))
        for o, h in (("second", 2), ("first", 1))
    ]
    fresh = medallion.new_rows(old, copies[0].unionByName(copies[1]), (key_time, "symbol"), ("processed_at",))
    return old.unionByName(fresh).select(key_time, "symbol", value, "origin")


@query
def gold_upsert_volume(spark, sf_dir):
    """Key conflicts change nothing."""
    rows = pipeline(spark, sf_dir).volume_spikes
    return _upserted(rows, "detected_at", F.unix_millis("detected_at") % 2 == 0, "spike_ratio")


@query
def gold_upsert_momentum(spark, sf_dir):
    """S11 J9"""
    rows = pipeline(spark, sf_dir).momentum_signals
    return _upserted(rows, "window_end_ts", F.unix_millis("detected_at") % 2 == 0, "pct_change")


@query
def gold_upsert_volatility(spark, sf_dir):
    """S11 J9"""
    rows = pipeline(spark, sf_dir).volatility_spikes
    return _upserted(rows, "detected_at", F.unix_millis("detected_at") % 2 == 0, "z_score")


@query
def gold_upsert_sector(spark, sf_dir):
    """S11 J9"""
    rows = pipeline(spark, sf_dir).sector_snapshots
    return _upserted(rows, "snapshot_ts", F.col("trade_count") % 2 == 0, "trade_count")


@query
def gold_volume_spikes(spark, sf_dir):
    """The gold table as reports read it."""
    return pipeline(spark, sf_dir).volume_spikes.drop("processed_at", "date")


@query
def gold_momentum_signals(spark, sf_dir):
    """S11 S16"""
    return pipeline(spark, sf_dir).momentum_signals.drop("processed_at", "date")


@query
def gold_volatility_spikes(spark, sf_dir):
    """S11 S16"""
    return pipeline(spark, sf_dir).volatility_spikes.drop("processed_at", "date")


@query
def gold_sector_snapshots(spark, sf_dir):
    """S11 S16 D13"""
    return rounded(pipeline(spark, sf_dir).sector_snapshots.drop("processed_at", "date"), "total_volume")


# ---- detectors -------------------------------------------------------------------------------------


@query
def rolling_window_stats(spark, sf_dir):
    """Each trade with its trailing window."""
    rolled = d.rolling_stats(trades(spark, sf_dir), CFG.volume_window_ms, CFG.window_parts)
    std = F.when(F.col("w_low") < F.col("w_high"), F.sqrt("w_price_var")).otherwise(0.0)
    out = rolled.select("s", "t", "seq", "w_count", "w_from", "w_volume", "w_price_mean", std.alias("w_price_std"))
    return rounded(out, "w_volume", "w_price_mean", "w_price_std")


@query
def volume_spike_candidates(spark, sf_dir):
    """D2 D3"""
    return d.volume_candidates(trades(spark, sf_dir), CFG)


@query
def volume_spikes(spark, sf_dir):
    """D3 D9"""
    return pipeline(spark, sf_dir).volume()


@query
def volatility_spike_candidates(spark, sf_dir):
    """D2 D4"""
    return d.volatility_candidates(trades(spark, sf_dir), CFG)


@query
def volatility_spikes(spark, sf_dir):
    """D4 D9"""
    return pipeline(spark, sf_dir).volatility()


@query
def candles(spark, sf_dir):
    """D5 A10 T2"""
    return rounded(d.candles(trades(spark, sf_dir), CFG.candle_ms), "volume")


@query
def completed_candles(spark, sf_dir):
    """D6"""
    return rounded(pipeline(spark, sf_dir).completed().drop("first_seq", "close_seq"), "volume")


@query
def late_trade_filter(spark, sf_dir):
    """Trades put in a jumbled arrival order; those behind a later minute are flagged."""
    delay = F.col("seq") * 7919 % 1000 * 20_000
    arrival = (F.col("t") + delay) * 1_048_576 + F.col("seq") % 1_048_576
    arriving = trades(spark, sf_dir).withColumn("arrival", arrival)
    flagged = d.late_flags(arriving, CFG.candle_ms, "arrival", 1_048_576 * CFG.candle_ms)
    return flagged.select("s", "t", "seq", "is_late")


@query
def momentum_candidates(spark, sf_dir):
    """D8"""
    return pipeline(spark, sf_dir).momentum_rows


@query
def momentum_signals(spark, sf_dir):
    """D8 D9"""
    return pipeline(spark, sf_dir).momentum()


@query
def cooldown_thin_query(spark, sf_dir):
    """D9 alone, on the densest stream: every trade is a candidate."""
    rows = trades(spark, sf_dir).select(F.col("s").alias("symbol"), F.col("t").alias("trade_ts"), "seq")
    return cooldown_thin(rows, ["symbol"], "trade_ts", "seq", CFG.volume_cooldown_ms)


_QUERIES["cooldown_thin"] = _QUERIES.pop("cooldown_thin_query")


@query
def sector_state(spark, sf_dir):
    """D10"""
    return rounded(d.sector_state(trades(spark, sf_dir), CFG.volume_window_ms), "total_volume")


@query
def sector_snapshots(spark, sf_dir):
    """D11 J10 P14"""
    return rounded(pipeline(spark, sf_dir).snapshots(), "total_volume")


def _nested(spark, sf_dir) -> DataFrame:
    return d.nest_snapshots(pipeline(spark, sf_dir).snapshots()).select(
        ms_to_iso(F.col("snapshot_ms")).alias("snapshot_ts"), "symbols"
    )


@query
def sector_snapshot_nested(spark, sf_dir):
    """One record per tick, shown as text."""
    text = F.transform(
        "symbols",
        lambda e: F.concat_ws(":", e["symbol"], e["trade_count"], F.coalesce(e["last_trade_ts"].cast("string"), F.lit("-"))),
    )
    return _nested(spark, sf_dir).select(
        "snapshot_ts", F.size("symbols").cast("bigint").alias("n"), F.array_join(text, "|").alias("symbols")
    )


@query
def sector_snapshot_explode(spark, sf_dir):
    """Nested records back to rows."""
    return rounded(d.explode_snapshots(_nested(spark, sf_dir), "snapshot_ts"), "total_volume")


@query
def session_reset(spark, sf_dir):
    """Windows that start anew after a silence."""
    cfg = replace(CFG, volume_multiplier=2.0)
    in_sessions = d.with_sessions(trades(spark, sf_dir), 6_000_000)
    found = d.volume_candidates(in_sessions, cfg, ("session_id",))
    return found.select("symbol", "session_id", "trade_ts", "spike_ratio", "window_trade_count")


def _restarted(spark, sf_dir) -> tuple[Pipeline, int]:
    """The detectors restarted at midnight, with what they replay."""
    start = int((datetime(DAY.year, DAY.month, DAY.day) - datetime(1970, 1, 1)).total_seconds() * 1000)
    replayed = d.replay_from(trades(spark, sf_dir), start, CFG.warm_start_ms)
    return once(spark, sf_dir, "restarted", lambda: Pipeline(spark, replayed, f"restarted:{sf_dir}", CFG)), start


def _in_sessions(spark, sf_dir) -> SessionPipeline:
    rows = trades(spark, sf_dir)
    return once(spark, sf_dir, "sessions", lambda: SessionPipeline(spark, rows, f"sessions:{sf_dir}", CFG, 6_000_000))


@query
def warm_start_replay(spark, sf_dir):
    """Signals of the detectors restarted at midnight."""
    p, start = _restarted(spark, sf_dir)
    return d.since(d.unify(p.volume(), p.momentum(), p.volatility()), start).select(
        "signal_type", "symbol", "trade_ts", "seq", "spike_ratio", "pct_change", "z_score"
    )


@query
def warm_start_snapshots(spark, sf_dir):
    """Snapshots of the sector detector restarted at midnight."""
    p, start = _restarted(spark, sf_dir)
    return rounded(p.snapshots().filter(F.col("snapshot_ms") >= start), "total_volume")


@query
def session_signals(spark, sf_dir):
    """Signals of all detectors, which start anew after a silence."""
    found = _in_sessions(spark, sf_dir).signals
    return found.select("signal_type", "symbol", "session_id", "trade_ts", "seq", "spike_ratio", "pct_change", "z_score")


@query
def session_features(spark, sf_dir):
    """The features to score those signals by, from trades of the same session."""
    return rounded(_in_sessions(spark, sf_dir).features(), *_FEATURE_ROUNDED)


@query
def session_snapshots(spark, sf_dir):
    """Snapshots of sessions; between them a symbol is like one without trades."""
    return rounded(_in_sessions(spark, sf_dir).snapshots(), "total_volume")


@query
def all_signals(spark, sf_dir):
    """The three detectors as one feed."""
    p = pipeline(spark, sf_dir)
    return d.feed(p.volume(), p.momentum(), p.volatility())


# ---- reports ---------------------------------------------------------------------------------------


def _live(spark, sf_dir) -> DataFrame:
    return q.all_realtime_signals(pipeline(spark, sf_dir), AS_OF, CFG)


def _report(name: str, build: Callable, *round_columns: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(spark, sf_dir, pipeline(spark, sf_dir)), *round_columns)

    run.__name__ = name
    run.__doc__ = getattr(q, name.removeprefix("q_")).__doc__
    _QUERIES[name] = run


_report("q_market_breadth", lambda spark, sf, g: q.market_breadth(g))
_report("q_signal_clusters", lambda spark, sf, g: q.signal_clusters(g, AS_OF, CFG))
_report("q_session_leaderboard", lambda spark, sf, g: q.session_leaderboard(g, AS_OF))
_report("q_opening_range", lambda spark, sf, g: q.opening_range(g, DAY, CFG))
_report("q_all_realtime_signals", lambda spark, sf, g: q.all_realtime_signals(g, AS_OF, CFG))
_report("q_rvol", lambda spark, sf, g: q.rvol(g, DAY), "hist_avg", "rvol")
_report("q_best_hours", lambda spark, sf, g: q.best_hours(g, DAY), "avg_ratio")
_report("q_signal_strength", lambda spark, sf, g: q.signal_strength(g, AS_OF, CFG), "avg_abs_move")
_report("q_multi_signal_confirmation", lambda spark, sf, g: q.multi_signal_confirmation(g, DAY, CFG))
_report("q_stock_correlation", lambda spark, sf, g: q.stock_correlation(g, AS_OF, CFG))
_report("q_volatility_regime", lambda spark, sf, g: q.volatility_regime(g, AS_OF), "avg_z")
_report("q_sector_rotation", lambda spark, sf, g: q.sector_rotation(g, DAY))
_report("q_signal_accuracy", lambda spark, sf, g: q.signal_accuracy(g, AS_OF, CFG))
_report("q_symbol_win_rates", lambda spark, sf, g: q.symbol_win_rates(g, AS_OF, CFG))
_report("q_per_signal_pnl", lambda spark, sf, g: q.per_signal_pnl(g, AS_OF, CFG))
_report("q_ml_score_distribution", lambda spark, sf, g: q.ml_score_distribution(g, DAY))
_report("q_ml_score_vs_strength", lambda spark, sf, g: q.ml_score_vs_strength(g, DAY))
_report("q_ml_confirmed_signals", lambda spark, sf, g: q.ml_confirmed_signals(g, DAY, CFG))


# ---- what a screen derives -------------------------------------------------------------------------


@query
def q_symbol_filter(spark, sf_dir):
    """P5"""
    return show.symbol_filter(_live(spark, sf_dir), ["click", "view"])


@query
def q_breadth_verdict(spark, sf_dir):
    """A12"""
    return show.breadth_verdict(q.market_breadth(pipeline(spark, sf_dir)))


@query
def q_signal_score(spark, sf_dir):
    """F21"""
    return show.with_score(_live(spark, sf_dir))


@query
def q_top_active(spark, sf_dir):
    """O4 F24"""
    return show.top_active(_live(spark, sf_dir))


@query
def q_signal_mix(spark, sf_dir):
    """A13"""
    return show.signal_mix(_live(spark, sf_dir))


@query
def q_orb_breakouts(spark, sf_dir):
    """P16"""
    return show.orb_breakouts(q.opening_range(pipeline(spark, sf_dir), DAY, CFG))


@query
def q_rvol_colored(spark, sf_dir):
    """P17"""
    return rounded(show.rvol_colored(q.rvol(pipeline(spark, sf_dir), DAY)), "hist_avg", "rvol")


@query
def q_top_pairs(spark, sf_dir):
    """O2 F23"""
    return show.top_pairs(q.stock_correlation(pipeline(spark, sf_dir), AS_OF, CFG))


@query
def q_ml_confirmed_live(spark, sf_dir):
    """F22"""
    return show.ml_confirmed_live(_live(spark, sf_dir), CFG.ml_confirmed)


@query
def q_ml_score_percentiles(spark, sf_dir):
    """A14"""
    return rounded(show.score_percentiles(q.ml_score_distribution(pipeline(spark, sf_dir), DAY)), "p50", "p90")


@query
def q_ml_score_histogram(spark, sf_dir):
    """A15"""
    return show.score_histogram(q.ml_score_distribution(pipeline(spark, sf_dir), DAY))


# ---- features, forest, evaluation ------------------------------------------------------------------

_FEATURE_ROUNDED = ("price_mean", "price_std", "volume_sum", "volume_mean", "price_change_pct")


def _features(spark, sf_dir) -> DataFrame:
    return features.feature_windows(trades(spark, sf_dir), CFG.feature_bucket_ms)


def _stored_features(spark, sf_dir) -> DataFrame:
    """The feature table as the feature job leaves it for training and evaluation."""
    return pipeline(spark, sf_dir).stage.table("features", lambda: _features(spark, sf_dir))


@query
def feature_windows(spark, sf_dir):
    """M1 A11"""
    return rounded(_features(spark, sf_dir).drop("bucket", "max_t"), *_FEATURE_ROUNDED)


@query
def feature_last100(spark, sf_dir):
    """M2"""
    recent = features.feature_recent(trades(spark, sf_dir), CFG.recent_trades, CFG.volume_window_ms)
    return rounded(recent, *_FEATURE_ROUNDED)


@query
def feature_at_signals(spark, sf_dir):
    """M2 M8: the same only for trades that made a signal, which is what gets scored."""
    signals = _signals(pipeline(spark, sf_dir))
    recent = features.feature_recent(trades(spark, sf_dir), CFG.recent_trades, CFG.volume_window_ms, signals)
    return rounded(recent, *_FEATURE_ROUNDED)


@query
def feature_batch(spark, sf_dir):
    """M3: batches of a hundred arrivals."""
    batches = trades(spark, sf_dir).withColumn("batch_id", F.expr("seq div 100"))
    return rounded(features.feature_batches(batches, "batch_id").drop("max_t"), *_FEATURE_ROUNDED)


@query
def feature_split(spark, sf_dir):
    """M4 S13"""
    return features.split_by_time(_features(spark, sf_dir), AS_OF, 2).select(
        "symbol", "event_time", "batch_trade_count", "split"
    )


def _scored(spark, sf_dir) -> DataFrame:
    """Feature rows with a made-up decision value, scaled; the same in ``oracle.py``."""
    raw = F.bround(F.col("price_change_pct") / 100 - F.col("volume_max") / 1000, 6)
    decided = _stored_features(spark, sf_dir).select("symbol", "bucket", raw.alias("raw"))
    return iforest.minmax_scores(decided, "raw").withColumn("score", F.bround("score", 6))


@query
def score_minmax(spark, sf_dir):
    """M6 F25"""
    return _scored(spark, sf_dir).drop("raw")


@query
def ml_eval_report(spark, sf_dir):
    """The symbol map shown as text."""
    entries = F.transform(
        F.map_entries("symbol_anomaly_rates"), lambda e: F.concat_ws("=", e["key"], F.format_string("%.4f", e["value"]))
    )
    return evaluation.report(_scored(spark, sf_dir)).select(
        "anomaly_rate", "score_p50", "score_p90", "score_p99", "n_records", F.array_join(entries, ",").alias("symbol_rates")
    )


@query
def ml_eval_by_symbol(spark, sf_dir):
    """M9"""
    return evaluation.rates_by_symbol(_scored(spark, sf_dir))


@query
def ml_gate(spark, sf_dir):
    """M10"""
    return evaluation.gate(evaluation.report(_scored(spark, sf_dir)))


_models: dict[tuple[str, str], iforest.IsolationForestModel] = {}


def _model(spark: SparkSession, sf_dir: str) -> iforest.IsolationForestModel:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        train = features.split_by_time(_stored_features(spark, sf_dir), AS_OF, 2).filter("split = 'train'")
        _models[key] = iforest.IsolationForest(key=("symbol", "bucket")).fit(train)
    return _models[key]


@query
def iforest_fit(spark, sf_dir):
    """M5: the shape of each tree: rows drawn, rows in its leaves, a full binary tree, depth within the limit."""
    nodes = spark.createDataFrame(_model(spark, sf_dir).nodes, iforest.NODES)
    leaf = F.col("feature") < 0
    return nodes.groupBy("tree").agg(
        F.max("sample_size").cast("bigint").alias("sample_size"),
        F.sum(F.when(leaf, F.col("size"))).alias("leaf_rows"),
        (F.count(F.lit(1)) == 2 * F.count_if(leaf) - 1).alias("is_full"),
        (F.max("depth") <= 8).alias("within_depth"),
    )


def _walked(rows: DataFrame, key: list[str], model: iforest.IsolationForestModel) -> DataFrame:
    """``walked``: the score by a second way, which joins the node table level by level and keeps to SQL functions."""
    nodes = rows.sparkSession.createDataFrame(model.nodes, iforest.NODES)
    n = F.col("size").cast("double")
    usual = F.when(n > 2, 2 * (F.log(n - 1) + iforest._EULER) - 2 * (n - 1) / n).when(n == 2, 1.0).otherwise(0.0)
    drawn = nodes.filter("node = 0").agg(F.avg(F.expr("cast(sample_size as double)")).alias("n")).first()["n"]
    norm = 2 * (math.log(drawn - 1) + iforest._EULER) - 2 * (drawn - 1) / drawn if drawn > 2 else 1.0
    steps = nodes.select("tree", "node", "feature", "threshold", "left_node", "right_node", F.col("depth") + usual)
    steps = F.broadcast(steps.toDF("tree", "node", "feature", "threshold", "left_node", "right_node", "length"))
    values = F.array(*[F.col(c).cast("double") for c in FEATURE_COLS]).alias("x")
    trees = int(model.nodes["tree"].max()) + 1
    at = rows.select(*key, values, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    goes_left = F.get("x", F.col("feature")) < F.col("threshold")
    step = F.when(F.col("feature") < 0, F.col("node")).when(goes_left, F.col("left_node")).otherwise(F.col("right_node"))
    for _ in range(int(model.nodes["depth"].max())):
        at = at.join(steps, ["tree", "node"]).select(*key, "x", "tree", step.alias("node"))
    raw = at.join(steps, ["tree", "node"]).groupBy(*key).agg((-F.pow(F.lit(2.0), -F.avg("length") / norm)).alias("raw"))
    return raw.select(*key, iforest.scaled_score(F.col("raw"), model.low, model.high).alias("walked"))


def _same_score(score: str) -> Column:
    return F.coalesce((F.abs(F.col(score) - F.col("walked")) < 1e-9) & F.col(score).between(0, 1), F.lit(False))


@query
def iforest_score(spark, sf_dir):
    """M7: every feature row and an outlier planted for each symbol. Whether the score is that of a second
    implementation, and whether an outlier is above nearly all rows."""
    model, key = _model(spark, sf_dir), ["symbol", "event_time"]
    own = _stored_features(spark, sf_dir).select(*key, *FEATURE_COLS)
    strange = [(F.max(c) * 5 + 100).alias(c) for c in FEATURE_COLS]
    planted = own.groupBy("symbol").agg(F.lit("planted").alias("event_time"), *strange)
    rows = own.unionByName(planted)
    scored = model.transform(rows).join(_walked(rows, key, model), key)
    usual = scored.filter("event_time <> 'planted'").agg(F.percentile("score", F.lit(0.98)).alias("usual"))
    high = (F.col("event_time") != "planted") | (F.col("score") >= F.lit(usual.first()["usual"]))
    return scored.select(*key, _same_score("score").alias("agrees"), high.alias("on_top"))


@query
def iforest_roundtrip(spark, sf_dir):
    """Scores of the fitted model, of the pipeline that it was saved in, and of a second implementation."""
    model, key = _model(spark, sf_dir), ["symbol", "event_time"]
    rows = _stored_features(spark, sf_dir).select(*key, *FEATURE_COLS)
    path = pipeline(spark, sf_dir).stage.folder("model", lambda path: PipelineModel([model]).write().overwrite().save(path))
    both = PipelineModel.load(path).transform(model.transform(rows).drop("raw").withColumnRenamed("score", "fitted"))
    same = (F.col("fitted") == F.col("score")) & _same_score("score")
    return both.join(_walked(rows, key, model), key).select(*key, same.alias("equal"))


@query
def signals_scored(spark, sf_dir):
    """M8: every signal, and whether its score is that of a second implementation on the latest hundred trades."""
    p = pipeline(spark, sf_dir)
    signals = _signals(p).select("signal_type", "symbol", "trade_ts", "seq", "detected_at")
    recent = features.feature_recent(trades(spark, sf_dir), CFG.recent_trades, CFG.volume_window_ms, signals)
    model, key = _model(spark, sf_dir), ["symbol", "t", "seq"]
    walked = _walked(recent, key, model).withColumnRenamed("t", "trade_ts")
    scored = iforest.score_signals(signals, recent, model).join(walked, ["symbol", "trade_ts", "seq"], "left")
    return scored.select("signal_type", "symbol", "trade_ts", "seq", _same_score("ml_anomaly_score").alias("agrees"))


@query
def model_registry(spark, sf_dir):
    """Versions of models offered with the evaluated rate and with rates at, within and outside the band."""
    p = pipeline(spark, sf_dir)

    def write(path: str) -> None:
        registry = evaluation.ModelRegistry(spark, path)
        rate = evaluation.report(_scored(spark, sf_dir)).first()["anomaly_rate"]
        for hours, offered in enumerate((rate, 0.03, 0.1, 0.2, round(rate + 0.2, 4), 0.0299)):
            version = registry.register(f"{p.stage.path}/model", offered, AS_OF + timedelta(hours=hours))
            if hours == 2 and version is not None:
                registry.approve(version, AS_OF + timedelta(days=1))

    path = p.stage.folder("model_versions", write)
    return evaluation.ModelRegistry(spark, path).current().drop("path")


@query
def model_registry_forest(spark, sf_dir):
    """The forest's own rate on the validation rows, which decides whether a version is registered. Whether the
    symbol's rate, the whole rate and the decision are those of a second implementation's scores."""
    p, model, key = pipeline(spark, sf_dir), _model(spark, sf_dir), ["symbol", "event_time"]
    held_out = features.split_by_time(_stored_features(spark, sf_dir), AS_OF, 2).filter("split = 'validation'")
    rows = held_out.select(*key, *FEATURE_COLS)
    scored = evaluation.report(model.transform(rows))
    result = scored.first()
    walked = _walked(rows, key, model)

    def write(path: str) -> None:
        evaluation.ModelRegistry(spark, path).register(f"{p.stage.path}/model", result["anomaly_rate"], AS_OF)

    versions = evaluation.ModelRegistry(spark, p.stage.folder("forest_versions", write)).current().collect()
    second = walked.agg(F.avg((F.col("walked") > evaluation.ANOMALOUS).cast("double"))).first()[0] or 0.0
    passed = evaluation.ACCEPT[0] <= result["anomaly_rate"] <= evaluation.ACCEPT[1]
    decided = [v["anomaly_rate"] for v in versions] == ([result["anomaly_rate"]] if passed else [])
    whole = decided and abs(second - result["anomaly_rate"]) < 1e-4
    own = scored.select(F.explode("symbol_anomaly_rates").alias("symbol", "own"))
    return evaluation.rates_by_symbol(walked, "walked").join(own, "symbol", "left").select(
        "symbol", "n_records", (F.coalesce(F.abs(F.col("own") - F.col("anomaly_rate")) < 2e-4, F.lit(False)) & F.lit(whole)).alias("agrees")
    )


def _forest_gold(spark, sf_dir) -> Pipeline:
    """Gold whose signals the approved forest has scored."""
    p, rows = pipeline(spark, sf_dir), trades(spark, sf_dir)

    def write(path: str) -> None:
        model_path = p.stage.folder("approved_model", lambda at: _model(spark, sf_dir).save(at))
        registry = evaluation.ModelRegistry(spark, path)
        registry.approve(registry.register(model_path, 0.1, AS_OF), AS_OF + timedelta(hours=1))

    def build() -> Pipeline:
        registry = evaluation.ModelRegistry(spark, p.stage.folder("approved_versions", write))
        score = training.approved_score(registry, rows, CFG, p.stage)
        scored = Pipeline(spark, rows, f"forest:{sf_dir}", CFG, score, ts_literal(AS_OF))
        for table in ("spike_rows", "bars", "ticks", "momentum_rows"):  # only gold differs
            setattr(scored, table, getattr(p, table))
        return scored

    return once(spark, sf_dir, "forest", build)


@query
def q_ml_confirmed_by_forest(spark, sf_dir):
    """The confirmed signals of a day from gold that the approved forest has scored. For each signal of the day,
    whether it is among them, and its score there, as a second implementation has it."""
    gold, model = _forest_gold(spark, sf_dir), _model(spark, sf_dir)
    signals = _signals(pipeline(spark, sf_dir)).select("signal_type", "symbol", "trade_ts", "seq")
    day = signals.withColumn("detected_at", ms_to_ts(F.col("trade_ts"))).filter(F.to_date("detected_at") == F.lit(DAY))
    recent = features.feature_recent(trades(spark, sf_dir), CFG.recent_trades, CFG.volume_window_ms, day)
    walked = _walked(recent, ["symbol", "t", "seq"], model).withColumnRenamed("t", "trade_ts")
    shown = q.ml_confirmed_signals(gold, DAY, CFG, 0.5).select("signal_type", "symbol", "detected_at", "ml_anomaly_score")
    both = day.join(walked, ["symbol", "trade_ts", "seq"]).join(shown, ["signal_type", "symbol", "detected_at"], "left")
    near = F.abs(F.col("walked") - 0.5) < 1e-9
    agrees = near | F.when(F.col("walked") >= 0.5, _same_score("ml_anomaly_score")).otherwise(F.col("ml_anomaly_score").isNull())
    return both.select("signal_type", "symbol", "detected_at", F.coalesce(agrees, F.lit(False)).alias("agrees"))
