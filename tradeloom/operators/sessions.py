"""What else starts anew when a symbol has been silent: the features to score by, and snapshots.

As in ``detectors.detect_in_sessions`` a symbol's session stands in for the symbol (``detectors.apart``), so no count, price or
latest trade reaches across a silence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.config import Settings
from tradeloom.functions.columns import bucket
from tradeloom.operators.detectors import SESSION_MARK, session_shown, snapshots_within
from tradeloom.operators.features import feature_recent


def features_in_sessions(apart: DataFrame, cfg: Settings, signals: DataFrame) -> DataFrame:
    """Features of the latest trades of the session at each signal, as the scorer of a feed with silences sees them.

    ``signals`` has ``symbol``, ``session_id``, ``trade_ts`` and ``seq``, and should be a stored table.
    """
    at = signals.withColumn("symbol", F.concat_ws(SESSION_MARK, "symbol", "session_id"))
    return session_shown(feature_recent(apart, cfg.recent_trades, cfg.volume_window_ms, at))


def snapshots_in_sessions(ticks: DataFrame, symbols: DataFrame, cfg: Settings, gap_ms: int) -> DataFrame:
    """State of every symbol's present session at every tick; between sessions a symbol is like one without trades.

    ``ticks`` are ``detectors.tick_states`` of trades that are ``apart``, and should be a stored table. A session is reported from
    its first tick until it has been silent for longer than the gap, or the next one begins. Each costs the ticks that it is
    reported at, so the work is that of the result. Where two sessions meet in one tick, the later one is reported.
    """
    step = cfg.snapshot_ms
    own = ticks.groupBy("s").agg(F.min("tick").alias("_t0"), F.max("last_t").alias("_to"), F.min("first_t").alias("_from"))
    in_order = Window.partitionBy("symbol").orderBy("_id")
    runs = session_shown(own.withColumn("symbol", F.col("s"))).withColumnRenamed("session_id", "_id")
    runs = runs.withColumn("_next", F.lead("_t0").over(in_order))
    ends = own.agg(F.min("_from"), F.max("_to")).first()
    if ends[0] is None:
        return snapshots_within(ticks, runs.select("s", "_t0", F.col("_t0").alias("_t1")), cfg)
    first, last = ends[0] // step + 1, ends[1] // step
    runs = runs.withColumn("_heard", F.col("_to") + gap_ms)
    runs = runs.withColumn("_t1", F.least(bucket("_heard", step), F.coalesce(F.col("_next") - 1, F.lit(last)), F.lit(last)))
    shown = snapshots_within(ticks, runs.select("s", F.greatest("_t0", F.lit(first)).alias("_t0"), "_t1"), cfg)
    # what lies before, between and after a symbol's sessions
    before = runs.select("symbol", F.coalesce(F.lag("_t1").over(in_order) + 1, F.lit(first)).alias("a"), (F.col("_t0") - 1).alias("b"))
    after = runs.filter("_next is null").select("symbol", (F.col("_t1") + 1).alias("a"), F.lit(last).alias("b"))
    never = symbols.join(runs.select(F.col("symbol").alias("s")).distinct(), "s", "left_anti")
    silent = before.union(after).union(never.select("s", F.lit(first), F.lit(last))).filter("a <= b")
    blank = {"trade_count": F.lit(0), "total_volume": F.lit(0.0), "is_stale": F.lit(False)}
    types = dict(shown.dtypes)
    at = silent.select("symbol", F.explode(F.transform(F.sequence("a", "b"), lambda tick: tick * step)).alias("snapshot_ms"))
    empty = at.select(*[F.col(c) if c in at.columns else blank.get(c, F.lit(None)).cast(types[c]).alias(c) for c in shown.columns])
    return session_shown(shown).drop("session_id").unionByName(empty)
