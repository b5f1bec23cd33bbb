"""Streaming queries from wire text to gold. Every job has its own checkpoint and can be restarted.

Sources and sinks are named by format and options, so files, as in the tests, or a message broker are a matter
of configuration. Limit a batch at the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tradeloom.config import Settings
from tradeloom.functions.columns import ms_to_iso, ms_to_ts
from tradeloom.operators.detectors import SNAPSHOT_FIELDS
from tradeloom.operators.evaluation import ModelRegistry
from tradeloom.operators.features import feature_batches
from tradeloom.operators.iforest import IsolationForestModel
from tradeloom.schemas import FEATURE_COLS, SIGNAL_TABLE, SNAPSHOT_ENTRY, TRADE, UNIFIED_SIGNAL
from tradeloom.sources import ingest, medallion
from tradeloom.streaming.processors import Plugin, SignalProcessor, SnapshotProcessor, TimedSnapshotProcessor

log = logging.getLogger(__name__)

#: Arrival numbers: a batch's own, and room for the order within it.
ORDER_SPAN = 1 << 40

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def source_options(fmt: str, options: Mapping[str, str]) -> dict[str, str]:
    """A consumer of a broker starts at the newest record, unless told otherwise; what it missed it replays from bronze."""
    newest = {"kafka": {"startingOffsets": "latest"}}
    return newest.get(fmt, {}) | dict(options)


def source(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """A stream with a string column ``value``: text files, or a broker whose value is cast."""
    raw = spark.readStream.format(fmt).options(**source_options(fmt, options)).load(path)
    return raw.withColumn("value", F.col("value").cast("string"))


def _start(
    writer: DataStreamWriter, checkpoint: str, once: bool, every: str = "60 seconds", path: str | None = None
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start(path) if path else writer.start()


# ---- raw stream ------------------------------------------------------------------------------------


def trades_from_frames(frames: DataFrame, cfg: Settings, received_ms: Column | None = None) -> DataFrame:
    """Valid trades ``(s, p, v, t)``; the time of receipt is the clock unless given as a column."""
    if received_ms is None:
        received_ms = F.unix_millis(F.current_timestamp())
    parsed = ingest.parse_frames(frames.withColumn("_received", received_ms), keep=("_received",))
    return ingest.valid_trades(parsed, cfg.symbols, F.col("_received"), cfg.ingest_staleness).select("s", "p", "v", "t")


def publish_trades(trades: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Valid trades as key and JSON value."""
    return _start(ingest.encode_trades(trades).writeStream.format("json"), checkpoint, once, path=path)


def trades_from_values(values: DataFrame, seq: Column) -> DataFrame:
    """Trades of the raw stream with their arrival number, such as a broker's offset. Trades of one symbol and time
    are worked on in its order, so it must be there and be unique among them."""
    return ingest.parse_trades(values.withColumn("seq", seq), "value", ("seq",)).filter(F.col("t").isNotNull())


def timed(trades: DataFrame, lateness: str) -> DataFrame:
    """Trades with their event time ``ts`` and its watermark, unless they have it already."""
    if "ts" in trades.columns:
        return trades
    return trades.withColumn("ts", ms_to_ts(F.col("t"))).withWatermark("ts", lateness)


def lateness_of(cfg: Settings, lateness: str | None) -> str:
    """How late a trade may be: as late as ingest accepts it, unless told otherwise."""
    return f"{cfg.ingest_staleness} milliseconds" if lateness is None else lateness


def distinct_trades(trades: DataFrame, cfg: Settings, lateness: str | None = None) -> DataFrame:
    """Each trade of the raw stream once, however often its record is delivered.

    The raw stream delivers at least once; a record keeps its arrival number, so a symbol's number that was seen before is dropped.
    Numbers are held as long as a trade may be late; a copy that comes after that is behind the watermark and is dropped as late.
    All consumers after this share its watermark.
    """
    return timed(trades, lateness_of(cfg, lateness)).dropDuplicatesWithinWatermark(["s", "seq"])


def heartbeat(spark: SparkSession, symbols: Sequence[str], every_s: int = 10) -> DataFrame:
    """A row without a price for each symbol, again and again, stamped by the clock."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load().filter(F.col("value") % every_s == 0)
    at = F.unix_millis("timestamp")
    none = F.lit(None).cast("double")
    # no trade has a negative arrival number
    return beats.select(F.explode(F.array(*map(F.lit, symbols))).alias("s"), none.alias("p"), none.alias("v"), at.alias("t"), (-at).alias("seq"))


def with_heartbeat(trades: DataFrame, beats: DataFrame) -> DataFrame:
    """Trades and heartbeats as one stream for the snapshots, which then report every symbol from the start and go on while the
    feed is silent. Comes before ``distinct_trades``, so that both share a watermark."""
    columns = ("s", "p", "v", "t", "seq")
    return trades.select(*columns).unionByName(beats.select(*columns))


# ---- consumers of the raw stream ----------------------------------------------------------------


def archive_bronze(
    values: DataFrame, path: str, checkpoint: str, once: bool = False, seq: Column | None = None
) -> list[StreamingQuery]:
    """Readable lines to hourly gzip folders by trade time, the rest to ``<path>_errors``.

    With ``seq``, the arrival number of a record (an offset), each line keeps its number, and so the archive the order in which
    trades of one time came.
    """
    parsed = values.select("value", F.from_json("value", TRADE).alias("d"), (F.lit(None) if seq is None else seq).alias("_seq"))
    readable = F.col("d.s").isNotNull() & F.col("d.t").isNotNull()
    parts = medallion.hourly_parts(ms_to_ts(F.col("d.t")))
    line = F.col("value") if seq is None else medallion.with_number(F.col("value"), F.col("_seq"))
    good = parsed.filter(readable).select(line.alias("value"), *[c.alias(n) for n, c in parts.items()])
    bad = parsed.filter(~F.coalesce(readable, F.lit(False))).select("value")
    gz = {"compression": "gzip"}
    return [
        _start(good.writeStream.format("text").options(**gz).partitionBy(*medallion.HOURLY), f"{checkpoint}/good", once, path=path),
        _start(bad.writeStream.format("text").options(**gz), f"{checkpoint}/bad", once, path=f"{path}_errors"),
    ]


def stream_candles(trades: DataFrame, cfg: Settings, lateness: str = "60 seconds") -> DataFrame:
    """Candles as a watermarked tumbling window; a candle appears once it can no longer change."""
    arrival = F.struct("t", "seq")
    return (
        timed(trades, lateness)
        .groupBy("s", F.window("ts", f"{cfg.candle_ms} milliseconds").alias("w"))
        .agg(
            F.min_by("p", arrival).alias("open"),
            F.max("p").alias("high"),
            F.min("p").alias("low"),
            F.max_by("p", arrival).alias("close"),
            F.sum("v").alias("volume"),
        )
        .withColumn("minute", F.expr(f"unix_millis(w.start) div {cfg.candle_ms}L"))
        .drop("w")
    )


def replacing(path: str, by: Sequence[str], batch_id: int) -> Callable[[DataFrame], None]:
    """A writer that files a batch under its number and, when the batch is run again, replaces just that."""

    def write(rows: DataFrame) -> None:
        (
            rows.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by, "batch_id")
            .parquet(path)
        )

    return write


def store_features(trades: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Features of each symbol and batch, apart from every other consumer of the trades."""

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = feature_batches(batch.withColumn("_batch", F.lit(batch_id)), "_batch")
        out = rows.select("symbol", "event_time", *FEATURE_COLS, F.to_date(ms_to_ts(F.col("max_t"))).alias("date"))
        replacing(path, ("date",), batch_id)(out)

    return _start(trades.writeStream.foreachBatch(load), checkpoint, once)


# ---- detectors -------------------------------------------------------------------------------------


def detect_signals(
    trades: DataFrame,
    cfg: Settings,
    warm: DataFrame | None = None,
    plugins: Mapping[str, Plugin] | None = None,
    gap_ms: int | None = None,
    lateness: str | None = None,
) -> DataFrame:
    """Signals of the three trade-driven detectors, and of any plugged in, with the features to score them by, with
    state per symbol.

    ``warm`` holds trades from before the start, such as ``medallion.recent_bronze``; they set the state of a new query
    and their own signals are dropped. With ``gap_ms`` a symbol's detectors and latest trades start anew after a silence longer
    than that, as ``sessions.detect_in_sessions`` does; trades later than ``lateness`` are then dropped.
    """
    schema = StructType.fromDDL(f"{UNIFIED_SIGNAL}, " + ", ".join(f"{c} double" for c in FEATURE_COLS))
    trades.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if gap_ms is not None:
        trades = timed(trades, lateness_of(cfg, lateness))
    return trades.groupBy("s").transformWithStateInPandas(
        statefulProcessor=SignalProcessor(cfg, schema.names, plugins, gap_ms),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None" if gap_ms is None else "EventTime",
        initialState=None if warm is None else warm.select("s", "p", "v", "t", "seq").groupBy("s"),
    )


def detect_snapshots(
    trades: DataFrame,
    cfg: Settings,
    lateness: str | None = None,
    gap_ms: int | None = None,
    warm: DataFrame | None = None,
    start_ms: int | None = None,
) -> DataFrame:
    """A row per symbol and tick, driven by event time.

    A tick waits for trades that are as late as ingest accepts them, unless another ``lateness`` is given. ``warm`` holds trades
    from before ``start_ms``: a new query goes on from the state that they give, with the first tick from there on. With
    ``gap_ms`` a symbol's session ends after a silence longer than that. A symbol is reported from its first row on, be it a
    trade, one of ``warm`` or a heartbeat.
    """
    if (warm is None) != (start_ms is None):
        raise ValueError("trades from before the start need the time of the start")
    trades.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    schema = StructType.fromDDL("snapshot_ms bigint, " + SNAPSHOT_ENTRY)
    return timed(trades, lateness_of(cfg, lateness)).groupBy("s").transformWithStateInPandas(
        statefulProcessor=SnapshotProcessor(cfg, gap_ms, start_ms),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
        initialState=None if warm is None else warm.filter(F.col("t") < start_ms).select("s", "p", "v", "t", "seq").groupBy("s"),
    )


def detect_timed_snapshots(trades: DataFrame, cfg: Settings) -> DataFrame:
    """A row per symbol and interval of the clock, driven by processing time: a silent feed is reported too."""
    trades.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    schema = StructType.fromDDL("snapshot_ms bigint, " + SNAPSHOT_ENTRY)
    return trades.groupBy("s").transformWithStateInPandas(
        statefulProcessor=TimedSnapshotProcessor(cfg), outputStructType=schema, outputMode="Append", timeMode="ProcessingTime"
    )


def complete_snapshots(rows: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Nested snapshot records of one batch in which symbols never seen appear with null prices."""
    seen = rows.groupBy("snapshot_ms").agg(F.collect_list(F.struct(*SNAPSHOT_FIELDS)).alias("seen"))
    blank = {"trade_count": F.lit(0), "total_volume": F.lit(0.0), "is_stale": F.lit(False)}
    types = {f.name: f.dataType for f in StructType.fromDDL(SNAPSHOT_ENTRY)}

    def unseen(symbol: Column) -> Column:
        values = {"symbol": symbol} | blank
        return F.struct(*[values.get(c, F.lit(None)).cast(types[c]).alias(c) for c in SNAPSHOT_FIELDS])

    absent = F.array_except(F.array(*[F.lit(s) for s in symbols]), F.transform("seen", lambda e: e["symbol"]))
    every = F.array_sort(F.concat("seen", F.transform(absent, unseen)))
    return seen.select(
        F.lit("sector_snapshot").alias("signal_type"), ms_to_iso(F.col("snapshot_ms")).alias("snapshot_ts"), every.alias("symbols")
    )


def publish_signals(
    signals: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    model: IsolationForestModel | ModelRegistry | None = None,
) -> StreamingQuery:
    """Signals as key and JSON value, scored where there is a model; without one the score stays null.

    Of a registry, the newest approved version scores each batch. A model that can't be read or fails leaves the score
    null and holds nothing up.
    """
    loaded: dict[str, IsolationForestModel] = {}

    def newest(spark: SparkSession) -> IsolationForestModel | None:
        if not isinstance(model, ModelRegistry):
            return model
        row = model.approved().first()
        if row is None:
            return None
        if row["path"] not in loaded:
            loaded[row["path"]] = IsolationForestModel.load(spark, row["path"])
        return loaded[row["path"]]

    def load(batch: DataFrame, batch_id: int) -> None:
        write = replacing(path, (), batch_id)
        try:
            scorer = newest(batch.sparkSession)
            if scorer is not None:
                write(ingest.encode_signals(scorer.transform(batch).withColumn("ml_anomaly_score", F.col("score"))))
                return
        except Exception:
            log.exception("batch %s is sent without scores", batch_id)
        write(ingest.encode_signals(batch))

    return _start(signals.writeStream.foreachBatch(load), checkpoint, once, every="5 seconds")


def publish_snapshots(
    snapshots: DataFrame, symbols: Sequence[str], path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Completed snapshot records as key and JSON value."""

    def load(batch: DataFrame, batch_id: int) -> None:
        replacing(path, (), batch_id)(ingest.encode_signals(complete_snapshots(batch, symbols)))

    return _start(snapshots.writeStream.foreachBatch(load), checkpoint, once)


# ---- signals to silver and gold --------------------------------------------------------------------


def load_signals(
    values: DataFrame,
    lake: str,
    checkpoint: str,
    once: bool = False,
    processed_at: Column | None = None,
    order: Column | None = None,
) -> StreamingQuery:
    """Validate signal records, archive them, add them to gold. Unfit records go to ``quarantine``.

    Running a batch again replaces its archive files and adds nothing to gold. Of records with one archive path the last
    one stays: by batch, then by ``order``, the source's number of a record (an offset). Without one, a hash of the
    record decides, so that a replay gives the same archive.
    """
    within = F.xxhash64("value") if order is None else order.cast("bigint")
    gold = medallion.GoldFolder(values.sparkSession, f"{lake}/gold")
    stamp = F.current_timestamp() if processed_at is None else processed_at

    def load(batch: DataFrame, batch_id: int) -> None:
        records = batch.select(F.col("value").alias("body"), F.pmod(within, F.lit(ORDER_SPAN)).alias("_order"))
        checked = ingest.validate_signals(records).persist()
        try:
            unfit = checked.filter(~F.col("is_valid")).select("body", "error")
            replacing(f"{lake}/quarantine", (), batch_id)(unfit)
            objects = medallion.route_silver(checked.withColumn("arrival", F.lit(batch_id * ORDER_SPAN) + F.col("_order")), "arrival")
            replacing(f"{lake}/silver", ("signal_type", "date"), batch_id)(objects)
            for kind, table in SIGNAL_TABLE.items():
                gold.upsert(table, medallion.gold_from_signals(checked, kind, stamp))
        finally:
            checked.unpersist()

    return _start(values.writeStream.foreachBatch(load), checkpoint, once)


def latest_silver(spark: SparkSession, lake: str) -> DataFrame:
    """The archive with one object per path: the one that arrived last."""
    rows = spark.read.parquet(f"{lake}/silver")
    rest = [c for c in rows.columns if c != "path"]
    newest = rows.groupBy("path").agg(F.max_by(F.struct(*rest), "arrival").alias("_o"))
    return newest.select("path", *[F.col(f"_o.{c}").alias(c) for c in rest])
