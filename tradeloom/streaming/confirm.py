"""Volume spikes confirmed by a momentum signal, live: a join of two streams in a band of time.

Both sides come from the stream of signal records. A signal may be delivered again, and late: each side has a watermark, takes each
signal once, and is kept in the join's state for the band and the lateness only, so the state is bounded by time however long
the streams run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeloom.config import Settings
from tradeloom.functions.columns import iso_to_ts
from tradeloom.sources import ingest
from tradeloom.streaming.jobs import _start


def _once(records: DataFrame, kind: str, key: str, lateness: str) -> DataFrame:
    """The typed signals of one kind, each key (as in gold) once, with ``at``, the event time.

    Every signal moves the watermark, so that a kind that hardly occurs doesn't keep the other's state: the kind is read by a
    generator after the watermark, which the filter on it is not pushed through.
    """
    checked = ingest.validate_signals(records.select(F.col("value").alias("body")))
    stamp = F.coalesce(F.col("values")["detected_at"], F.col("values")["snapshot_ts"])
    stamped = checked.withColumnRenamed("signal_type", "_kind").withColumn("at", F.when(F.col("is_valid"), iso_to_ts(stamp)))
    each = ingest.computed_once(stamped.withWatermark("at", lateness), "signal_type", F.col("_kind"))
    return ingest.typed_signals(each, kind, ("at",)).dropDuplicatesWithinWatermark(["symbol", key])


def confirmations(records: DataFrame, cfg: Settings, lateness: str = "10 minutes") -> DataFrame:
    """Spikes with each momentum signal of the same symbol within the confirmation distance, as report Q9 shows them.

    ``records`` is the stream of signals with a JSON string ``value``. The distance is in whole seconds, so the band in which the
    streams are joined is a second wider, and the exact distance is tested on what meets. Records later than ``lateness`` are
    dropped, as are those that don't validate.
    """
    seconds = cfg.confirm_ms // 1000
    spikes = _once(records, "volume_spike", "detected_at", lateness).select(
        "symbol", F.col("at").alias("vol_time"), "spike_ratio"
    )
    momentum = _once(records, "momentum_signal", "window_end_ts", lateness).select(
        F.col("symbol").alias("_symbol"), F.col("at").alias("mom_time"), "direction"
    )
    reach = F.expr(f"INTERVAL {seconds + 1} SECONDS")
    near = F.col("mom_time").between(F.col("vol_time") - reach, F.col("vol_time") + reach)
    apart = F.unix_seconds("mom_time") - F.unix_seconds("vol_time")
    joined = spikes.join(momentum, (F.col("symbol") == F.col("_symbol")) & near)
    return joined.withColumn("seconds_apart", apart).filter(F.abs("seconds_apart") <= seconds).drop("_symbol")


def publish_confirmations(confirmed: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Confirmations as Parquet by the spike's day; a batch that is run again leaves its files once."""
    columns = ("symbol", "vol_time", "mom_time", "seconds_apart", "spike_ratio", "direction")
    rows = confirmed.select(*columns, F.to_date("vol_time").alias("date"))
    return _start(rows.writeStream.format("parquet").partitionBy("date"), checkpoint, once, every="5 seconds", path=path)
