"""Detectors for streams in which one symbol may hold most trades: a micro-batch runs in slices of time, not by symbol.

``jobs.detect_signals`` keeps a symbol in one state key, so its part of a batch is one task. Here the state is a few tables in the
shared folder, written anew with each batch, and a batch is worked on by the batch operators over those tables and the batch's
trades: a symbol's window is cut into slices whose totals are passed on, its cooldown into blocks, its candles and ticks are
pre-aggregated. A batch therefore costs the tail of the windows plus itself, spread over all tasks whatever symbol it is in.

A batch that is run again starts from the state before it and replaces what it wrote. Trades of one symbol and time are taken in
the order of their arrival numbers. The results are those of the batch operators for trades that come in order; a late
trade counts in the windows after it, but what was already reported stays, and a candle that was closed stays closed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tradeloom.config import Settings
from tradeloom.functions.columns import bucket
from tradeloom.operators import detectors as d
from tradeloom.operators.blocks import numbered
from tradeloom.operators.features import feature_recent
from tradeloom.operators.iforest import IsolationForestModel, score_signals
from tradeloom.operators.skew import time_blocks
from tradeloom.schemas import FEATURE_COLS
from tradeloom.sources import ingest
from tradeloom.streaming.jobs import _start, complete_snapshots, replacing

TRADES = "s string, p double, v double, t bigint, seq bigint"
BARS = "s string, minute bigint, open double, high double, low double, close double, volume double, first_t bigint, first_seq bigint"
FOLDS = "s string, tick bigint, open double, last double, n bigint, volume double, first_t bigint, last_t bigint"


class BatchState:
    """Tables written with each batch; a batch reads those of the one before it.

    The tables of the last ``kept`` batches stay, older ones are deleted. A mark, written last, tells that a batch's are whole.
    """

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, str], kept: int = 2):
        self.spark, self.path, self.tables, self.kept = spark, path.rstrip("/"), tables, kept

    def _fs(self):
        sc = self.spark.sparkContext
        root = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(sc._jsc.hadoopConfiguration()), sc._jvm.org.apache.hadoop.fs.Path

    def batches(self) -> list[int]:
        """The batches whose tables are whole."""
        root, fs, path = self._fs()
        names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
        numbers = sorted(int(m[1]) for n in names if (m := re.fullmatch(r"batch=(\d+)", n)))
        return [n for n in numbers if fs.exists(path(f"{self.path}/batch={n}/_whole"))]

    def before(self, batch_id: int) -> dict[str, DataFrame]:
        """The tables of the newest batch before this one; empty ones before the first."""
        known = [n for n in self.batches() if n < batch_id]
        if not known:
            return {name: self.spark.createDataFrame([], ddl) for name, ddl in self.tables.items()}
        return {name: self.spark.read.schema(ddl).parquet(f"{self.path}/batch={known[-1]}/{name}") for name, ddl in self.tables.items()}

    def write(self, batch_id: int, name: str, rows: DataFrame) -> DataFrame:
        """Write a table of this batch, in place of what an earlier run of it left; returns it read back."""
        folder = f"{self.path}/batch={batch_id}/{name}"
        schema = StructType.fromDDL(self.tables[name])
        rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(schema).parquet(folder)

    def finish(self, batch_id: int) -> None:
        _, fs, path = self._fs()
        fs.create(path(f"{self.path}/batch={batch_id}/_whole"), True).close()
        for old in self.batches()[: -self.kept]:
            fs.delete(path(f"{self.path}/batch={old}"), True)


class SlicedSignals:
    """Signals of the three trade-driven detectors with the features to score them by, batch by batch."""

    STATE = {"tail": TRADES, "bars": BARS, "fired": "symbol string, signal_type string, at bigint", "signals": ""}

    def __init__(self, spark: SparkSession, cfg: Settings, path: str):
        self.cfg, self.width = cfg, max(cfg.volume_window_ms, cfg.volatility_window_ms)
        self.state = BatchState(spark, path, {k: v for k, v in self.STATE.items() if v})

    def run(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The signals of a batch's trades (s, p, v, t, seq), and the state for the next batch."""
        cfg, state = self.cfg, self.state.before(batch_id)
        new = batch.select("s", "p", "v", "t", "seq")
        known = state["tail"].withColumn("_new", F.lit(False)).union(new.withColumn("_new", F.lit(True)))
        flagged = d.spike_rows(known, cfg).filter("_new")
        volume = self._rested(d.volume_fields(flagged.filter("is_volume")), state, "volume_spike", cfg.volume_cooldown_ms)
        volatility = self._rested(d.volatility_fields(flagged.filter("is_volatility")), state, "volatility_spike", cfg.volatility_cooldown_ms)
        bars, closed_from = self._bars(new, state["bars"])
        candidates = d.momentum_candidates(d.completed_candles(bars), cfg).join(closed_from, "symbol", "left")
        fresh = candidates.filter(F.col("window_end_ts") > F.coalesce(F.col("_open") * cfg.candle_ms, F.lit(0))).drop("_open")
        momentum = self._rested(fresh, state, "momentum_signal", cfg.momentum_cooldown_ms)
        found = d.unify(volume, momentum, volatility)
        self.state.tables["signals"] = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
        signals = self.state.write(batch_id, "signals", found)

        last = signals.groupBy("symbol", "signal_type").agg(F.max("trade_ts").alias("at"))
        fired = state["fired"].union(last.select("symbol", "signal_type", "at")).groupBy("symbol", "signal_type").agg(F.max("at").alias("at"))
        self.state.write(batch_id, "fired", fired)
        self.state.write(batch_id, "bars", self._latest(bars))
        whole = known.drop("_new")
        self.state.write(batch_id, "tail", self._tail(whole))
        recent = feature_recent(whole, cfg.recent_trades, cfg.volume_window_ms, signals)
        return signals.join(recent.select("symbol", F.col("t").alias("trade_ts"), "seq", *FEATURE_COLS), ["symbol", "trade_ts", "seq"], "left")

    def _rested(self, candidates: DataFrame, state: dict[str, DataFrame], kind: str, cooldown_ms: int) -> DataFrame:
        """Candidates after the cooldown of what fired in earlier batches, thinned among themselves."""
        last = state["fired"].filter(F.col("signal_type") == kind).select("symbol", "at")
        free = candidates.join(last, "symbol", "left").filter(F.col("at").isNull() | (F.col("trade_ts") - F.col("at") >= cooldown_ms))
        return d.cooldown_thin(free.drop("at"), ["symbol"], "trade_ts", "seq", cooldown_ms)

    def _bars(self, new: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The latest candles before this batch, gone on with its trades, and the minute that was open before for each symbol."""
        cfg = self.cfg
        opened = old.groupBy(F.col("s").alias("symbol")).agg(F.max("minute").alias("_open"))
        made = d.candles(new, cfg.candle_ms).join(opened.withColumnRenamed("symbol", "s"), "s", "left")
        on_time = made.filter(F.col("_open").isNull() | (F.col("minute") >= F.col("_open"))).drop("_open")
        both = old.withColumn("_part", F.lit(0)).unionByName(on_time.withColumn("_part", F.lit(1)))
        grown = both.groupBy("s", "minute").agg(
            F.min_by("open", "_part").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", "_part").alias("close"), F.sum("volume").alias("volume"),
            F.min_by("first_t", "_part").alias("first_t"), F.min_by("first_seq", "_part").alias("first_seq"),
        )
        return grown, opened

    def _latest(self, bars: DataFrame) -> DataFrame:
        """What the next batch needs: the open candle of each symbol and as many before it as momentum looks at."""
        ranked = numbered(bars.withColumn("_day", bucket("minute", 1440)), ["s"], "_day", ["minute"])
        most = bars.groupBy("s").agg(F.count(F.lit(1)).alias("_all"))
        return ranked.join(most, "s").filter(F.col("_all") - F.col("rn") <= self.cfg.momentum_candles)

    def _tail(self, known: DataFrame) -> DataFrame:
        """The trades that a later window, also that of a trade as late as ingest accepts, or the latest trades reach back to."""
        cfg = self.cfg
        reach = known.groupBy("s").agg(F.max("t").alias("_to"), F.count(F.lit(1)).alias("_all"))
        blocked = time_blocks(known, ["s"], "t", "seq", cfg.volume_window_ms)
        ranked = numbered(blocked, ["s"], "_block", ["t", "seq"]).join(reach, "s")
        near = F.col("t") >= F.col("_to") - self.width - cfg.ingest_staleness
        return ranked.filter(near | (F.col("_all") - F.col("rn") < cfg.recent_trades))


class SlicedSnapshots:
    """Snapshots of all symbols seen, batch by batch: ticks are folded by all tasks before a symbol's folds meet.

    A tick is reported once trades of later than ``lateness_ms`` after it have been seen; later ones are dropped.
    """

    STATE = {"ticks": FOLDS, "sessions": FOLDS, "due": "s string, due bigint", "seen": "latest bigint"}

    def __init__(self, spark: SparkSession, cfg: Settings, path: str, lateness_ms: int | None = None):
        self.cfg, self.lateness_ms = cfg, cfg.ingest_staleness if lateness_ms is None else lateness_ms
        self.state = BatchState(spark, path, dict(self.STATE))

    def run(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The snapshot rows that become due with a batch's trades, and the state for the next batch."""
        cfg, step, state = self.cfg, self.cfg.snapshot_ms, self.state.before(batch_id)
        passed = state["seen"].agg(F.max("latest")).first()[0]
        passed = None if passed is None else passed - self.lateness_ms
        on_time = batch if passed is None else batch.filter(F.col("t") >= passed)
        seen = self.state.write(batch_id, "seen", state["seen"].union(batch.select(F.col("t").alias("latest"))).agg(F.max("latest").alias("latest")))
        latest = seen.first()["latest"]
        until = -(-(latest - self.lateness_ms) // step) - 1 if latest is not None else None  # ticks before that time
        made = d.tick_states(on_time, step).withColumn("_part", F.lit(1)).unionByName(state["ticks"].withColumn("_part", F.lit(0)))
        early, late = F.struct("first_t", "_part"), F.struct("last_t", "_part")
        ticks = made.groupBy("s", "tick").agg(
            F.min_by("open", early).alias("open"), F.max_by("last", late).alias("last"), F.sum("n").alias("n"),
            F.sum("volume").alias("volume"), F.min("first_t").alias("first_t"), F.max("last_t").alias("last_t"),
        )
        first = ticks.groupBy("s").agg(F.min("tick").alias("_first"))
        due = state["due"].join(first, "s", "full").select("s", F.coalesce("due", "_first").alias("due"))
        if until is None:
            until = -(2**62)
        # the session so far is a fold of the tick before the first one due
        sessions = state["sessions"].join(due, "s").withColumn("tick", F.col("due") - 1).drop("due")
        passed_ticks = ticks.filter(F.col("tick") <= until)
        folds = sessions.unionByName(passed_ticks)
        reach = due.filter(F.col("due") <= until).select("s", (F.col("due") - 1).alias("_t0"), F.lit(until).cast("bigint").alias("_t1"))
        rows = d.snapshots_within(folds, reach, cfg).join(due.withColumnRenamed("s", "symbol"), "symbol")
        self.state.tables["rows"] = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("due").schema)
        found = self.state.write(batch_id, "rows", rows.filter(F.col("snapshot_ms") >= F.col("due") * step))
        grown = folds.groupBy("s").agg(
            F.max("tick").alias("tick"), F.min_by("open", "tick").alias("open"), F.max_by("last", "tick").alias("last"), F.sum("n").alias("n"),
            F.sum("volume").alias("volume"), F.min("first_t").alias("first_t"), F.max("last_t").alias("last_t"),
        )
        self.state.write(batch_id, "sessions", grown)
        self.state.write(batch_id, "ticks", ticks.filter(F.col("tick") > until))
        self.state.write(batch_id, "due", due.select("s", F.greatest("due", F.lit(until + 1)).alias("due")))
        return found


def publish_sliced_signals(
    trades: DataFrame, cfg: Settings, path: str, state: str, checkpoint: str, once: bool = False, model: IsolationForestModel | None = None
) -> StreamingQuery:
    """Signals as key and JSON value, as ``jobs.publish_signals`` gives them, for a feed whose symbols may be hot."""
    detector = SlicedSignals(trades.sparkSession, cfg, state)

    def load(batch: DataFrame, batch_id: int) -> None:
        found = detector.run(batch, batch_id)
        if model is not None:
            scored = found.select("symbol", F.col("trade_ts").alias("t"), "seq", *FEATURE_COLS).distinct()
            found = score_signals(found, scored, model)
        replacing(path, (), batch_id)(ingest.encode_signals(found))
        detector.state.finish(batch_id)

    return _start(trades.writeStream.foreachBatch(load), checkpoint, once, every="5 seconds")


def publish_sliced_snapshots(
    trades: DataFrame, cfg: Settings, path: str, state: str, checkpoint: str, once: bool = False, lateness_ms: int | None = None
) -> StreamingQuery:
    """Completed snapshot records as key and JSON value, for a feed whose symbols may be hot."""
    detector = SlicedSnapshots(trades.sparkSession, cfg, state, lateness_ms)

    def load(batch: DataFrame, batch_id: int) -> None:
        found = detector.run(batch, batch_id)
        replacing(path, (), batch_id)(ingest.encode_signals(complete_snapshots(found, cfg.symbols)))
        detector.state.finish(batch_id)

    return _start(trades.writeStream.foreachBatch(load), checkpoint, once)
