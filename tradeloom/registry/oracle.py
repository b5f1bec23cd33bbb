"""The registered queries as DuckDB SQL over the same tables, each one self-contained."""

from __future__ import annotations

import re

from tradeloom.config import SIGNAL_PREFIX
from tradeloom.registry.inputs import AS_OF, CFG, DAY

C = CFG
NOW = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
TODAY = f"DATE '{AS_OF:%Y-%m-%d}'"
THAT_DAY = f"DATE '{DAY:%Y-%m-%d}'"


def he(x: str, n: int) -> str:
    """Half-even rounding decided on decimal digits, as the Spark side does."""
    return f"round_even(({x})::DECIMAL(28, 9), {n})::DOUBLE"


def r4(x: str) -> str:
    return he(x, 4)


def ts(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)"


def ms(at: str) -> str:
    return f"(epoch_us({at}) // 1000)"


def secs(at: str) -> str:
    return f"(epoch_us({at}) // 1000000)"


def _cooldown(cands: str, cooldown: int) -> tuple[str, str, str]:
    ranked = f"SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, seq) AS rn FROM {cands}"
    chain = f"""
        SELECT symbol, rn, trade_ts AS last_fire, true AS kept FROM {cands}_ranked WHERE rn = 1
        UNION ALL
        SELECT c.symbol, c.rn,
               CASE WHEN c.trade_ts - k.last_fire >= {cooldown} THEN c.trade_ts ELSE k.last_fire END,
               c.trade_ts - k.last_fire >= {cooldown}
        FROM {cands}_chain k JOIN {cands}_ranked c ON c.symbol = k.symbol AND c.rn = k.rn + 1"""
    kept = f"SELECT r.* EXCLUDE (rn) FROM {cands}_ranked r JOIN {cands}_chain k USING (symbol, rn) WHERE k.kept"
    return ranked, chain, kept


CTES: dict[str, str] = {
    "trades": """
        SELECT event_type AS s, 100.0::DOUBLE + k * k * k * k / 1e6::DOUBLE AS p, value AS v,
               epoch_us(ts) // 1000 AS t, event_id AS seq
        FROM (SELECT *, regexp_extract(props, '"k": *([0-9]+)', 1)::DOUBLE AS k FROM events)""",
    "rolled": f"""
        SELECT *, count(*) OVER w AS w_count, min(t) OVER w AS w_from, sum(v) OVER w AS w_volume,
               min(p) OVER w AS w_low, max(p) OVER w AS w_high, avg(p) OVER w AS w_mean, var_pop(p) OVER w AS w_var
        FROM trades
        WINDOW w AS (PARTITION BY s ORDER BY t RANGE BETWEEN {C.volume_window_ms} PRECEDING AND CURRENT ROW)""",
    "volume_cands": f"""
        SELECT s AS symbol, p AS price, v AS trade_volume, {he("m", 2)} AS avg_volume, {he("v / m", 2)} AS spike_ratio,
               w_count::INT AS window_trade_count, {he("(t - w_from)::DOUBLE / 1000", 1)} AS window_span_secs,
               t AS trade_ts, seq
        FROM (SELECT *, (w_volume - v) / (w_count - 1) AS m FROM rolled WHERE w_count >= 2)
        WHERE t - w_from >= {C.volume_min_span_ms} AND m > 0 AND v >= m * {C.volume_multiplier}::DOUBLE * (1 - 1e-11::DOUBLE)""",
    "volatility_cands": f"""
        SELECT s AS symbol, p AS price, {he("w_mean", 4)} AS mean_price, {he("sqrt(w_var)", 4)} AS std_dev,
               {he("z", 3)} AS z_score, w_count::INT AS window_trade_count,
               {he("(t - w_from)::DOUBLE / 1000", 1)} AS window_span_secs, t AS trade_ts, seq
        FROM (SELECT *, abs(p - w_mean) / sqrt(w_var) AS z FROM rolled
              WHERE w_count >= 2 AND w_low < w_high AND w_var > 0)
        WHERE t - w_from >= {C.volatility_min_span_ms} AND z >= {C.volatility_z}::DOUBLE * (1 - 1e-9::DOUBLE)""",
    "bars": f"""
        SELECT s, t // {C.candle_ms} AS minute, first(p ORDER BY t, seq) AS open, max(p) AS high, min(p) AS low,
               last(p ORDER BY t, seq) AS close, sum(v) AS volume, min(t) AS first_t,
               first(seq ORDER BY t, seq) AS first_seq
        FROM trades GROUP BY 1, 2""",
    "completed": """
        SELECT * FROM (SELECT *, lead(first_t) OVER w AS close_t, lead(first_seq) OVER w AS close_seq FROM bars
                       WINDOW w AS (PARTITION BY s ORDER BY minute))
        WHERE close_t IS NOT NULL""",
    "momentum_cands": f"""
        SELECT s AS symbol, CASE WHEN up >= {C.momentum_min_agree} THEN 'UP' ELSE 'DOWN' END AS direction,
               (CASE WHEN up >= {C.momentum_min_agree} THEN up ELSE n - up END)::INT AS candles_in_direction,
               n::INT AS total_candles, oldest_open, close AS latest_close,
               {he("(close - oldest_open) / oldest_open * 100", 3)} AS pct_change,
               oldest_minute * {C.candle_ms} AS window_start_ts, (minute + 1) * {C.candle_ms} AS window_end_ts,
               close_t AS trade_ts, close_seq AS seq
        FROM (SELECT *, count(*) OVER w AS n, sum((close >= open)::INT) OVER w AS up,
                     first_value(open) OVER w AS oldest_open, first_value(minute) OVER w AS oldest_minute
              FROM completed
              WINDOW w AS (PARTITION BY s ORDER BY minute ROWS BETWEEN {C.momentum_candles - 1} PRECEDING AND CURRENT ROW))
        WHERE n = {C.momentum_candles} AND (up >= {C.momentum_min_agree} OR n - up >= {C.momentum_min_agree})""",
    "snapshots": f"""
        SELECT tick * {C.snapshot_ms} AS snapshot_ms, symbol, last_price, open_price,
               {he("(last_price - open_price) / open_price * 100", 3)} AS pct_change,
               trade_count::INT AS trade_count, total_volume, last_trade_ts,
               coalesce(tick * {C.snapshot_ms} - last_trade_ts > {C.stale_ms}, false) AS is_stale
        FROM (
            SELECT g.tick, g.s AS symbol, last_value(x.last_p IGNORE NULLS) OVER w AS last_price,
                   first_value(x.open_p IGNORE NULLS) OVER w AS open_price, coalesce(sum(x.n) OVER w, 0) AS trade_count,
                   coalesce(sum(x.vol) OVER w, 0.0) AS total_volume, max(x.last_t) OVER w AS last_trade_ts
            FROM (SELECT s, unnest(range(lo, hi + 1)) AS tick
                  FROM (SELECT DISTINCT s FROM trades)
                  CROSS JOIN (SELECT min(t) // {C.snapshot_ms} + 1 AS lo, max(t) // {C.snapshot_ms} AS hi FROM trades)) g
            LEFT JOIN (SELECT s, (t + {C.snapshot_ms - 1}) // {C.snapshot_ms} AS tick, first(p ORDER BY t, seq) AS open_p,
                              last(p ORDER BY t, seq) AS last_p, count(*) AS n, sum(v) AS vol, max(t) AS last_t
                       FROM trades GROUP BY 1, 2) x
              ON x.s = g.s AND x.tick = g.tick
            WINDOW w AS (PARTITION BY g.s ORDER BY g.tick ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "volume_spikes": f"""
        SELECT {ts("trade_ts")} AS timestamp, {ts("trade_ts")} AS detected_at, * EXCLUDE (trade_ts), trade_ts,
               CASE WHEN seq % 10 <> 0 THEN (trade_ts % 1000)::DOUBLE / 1000 END AS ml_anomaly_score
        FROM volume_kept""",
    "momentum_signals": f"""
        SELECT {ts("trade_ts")} AS detected_at, *,
               CASE WHEN seq % 10 <> 0 THEN (trade_ts % 1000)::DOUBLE / 1000 END AS ml_anomaly_score
        FROM momentum_kept""",
    "volatility_spikes": f"""
        SELECT {ts("trade_ts")} AS timestamp, {ts("trade_ts")} AS detected_at, *,
               CASE WHEN seq % 10 <> 0 THEN (trade_ts % 1000)::DOUBLE / 1000 END AS ml_anomaly_score
        FROM volatility_kept""",
    "sector_snapshots": f"SELECT {ts('snapshot_ms')} AS snapshot_ts, * FROM snapshots",
    "fired": """
        SELECT symbol, detected_at FROM volume_spikes UNION ALL SELECT symbol, detected_at FROM momentum_signals
        UNION ALL SELECT symbol, detected_at FROM volatility_spikes""",
    "feed": """
        SELECT symbol, detected_at, 'volume_spike' AS signal_type, spike_ratio AS strength, price, ml_anomaly_score
        FROM volume_spikes
        UNION ALL SELECT symbol, detected_at, 'momentum_signal', abs(pct_change), latest_close, ml_anomaly_score
        FROM momentum_signals
        UNION ALL SELECT symbol, detected_at, 'volatility_spike', z_score, price, ml_anomaly_score
        FROM volatility_spikes""",
    "live": f"""
        SELECT * FROM feed WHERE detected_at >= {NOW} - INTERVAL {C.live_lookback_ms} MILLISECOND
          AND detected_at::DATE = {TODAY}""",
    "opening": f"""
        SELECT symbol, detected_at, price, spike_ratio, orb_high, orb_low,
               CASE WHEN price > orb_high THEN 'BREAKOUT_UP' WHEN price < orb_low THEN 'BREAKOUT_DOWN' ELSE 'IN_RANGE' END
                   AS orb_status
        FROM volume_spikes JOIN (
            SELECT symbol, max(last_price) AS orb_high, min(last_price) AS orb_low FROM sector_snapshots
            WHERE snapshot_ts BETWEEN {THAT_DAY} AND {THAT_DAY} + INTERVAL 10 HOUR GROUP BY 1) USING (symbol)
        WHERE detected_at::DATE = {THAT_DAY} AND detected_at > {THAT_DAY} + INTERVAL 10 HOUR""",
    "rvol": f"""
        SELECT t.hour, t.today_count, coalesce(h.avg_n, 0) AS hist_avg,
               CASE WHEN coalesce(h.avg_n, 0) > 0 THEN t.today_count / h.avg_n END AS rvol
        FROM (SELECT hour(detected_at) AS hour, count(*) AS today_count FROM volume_spikes
              WHERE detected_at::DATE = {THAT_DAY} GROUP BY 1) t
        LEFT JOIN (SELECT hour(detected_at) AS hour, count(*)::DOUBLE / count(DISTINCT detected_at::DATE) AS avg_n
                   FROM volume_spikes WHERE detected_at >= {THAT_DAY} - INTERVAL 30 DAY AND detected_at < {THAT_DAY}
                   GROUP BY 1) h USING (hour)""",
    "pairs": f"""
        SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, count(*) AS co_signal_count
        FROM volume_spikes a JOIN volume_spikes b
          ON b.symbol > a.symbol AND a.detected_at::DATE = b.detected_at::DATE
         AND abs({secs("b.detected_at")} - {secs("a.detected_at")}) <= {C.pair_ms // 1000}
        WHERE a.detected_at >= {TODAY} - INTERVAL 30 DAY
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
    # Recent spikes with every snapshot of their symbol in the exit band; spikes without one appear once.
    "banded": f"""
        SELECT spike.symbol, spike.detected_at, spike.price, spike.spike_ratio, later.last_price, later.pct_change
        FROM volume_spikes spike LEFT JOIN snapshots later
          ON later.symbol = spike.symbol
         AND later.snapshot_ms - spike.trade_ts BETWEEN {C.exit_from_ms} AND {C.exit_to_ms}
        WHERE spike.detected_at >= {TODAY} - INTERVAL 30 DAY""",
    "returns": """
        SELECT symbol, detected_at, price, avg(last_price) AS exit_price FROM banded
        WHERE spike_ratio >= 4.0 GROUP BY ALL""",
    "scores": f"""
        SELECT * FROM feed WHERE detected_at::DATE = {THAT_DAY} AND ml_anomaly_score IS NOT NULL""",
    "features": f"""
        SELECT s AS symbol, t // {C.feature_bucket_ms} AS bucket, max(t) AS max_t, count(*)::DOUBLE AS batch_trade_count,
               avg(p) AS price_mean, stddev_pop(p) AS price_std, min(p) AS price_min, max(p) AS price_max,
               sum(v) AS volume_sum, avg(v) AS volume_mean, max(v) AS volume_max,
               (last(p ORDER BY t, seq) - first(p ORDER BY t, seq)) / first(p ORDER BY t, seq) * 100 AS price_change_pct,
               strftime({ts("max(t)")}, '%Y-%m-%dT%H:%M:%SZ') AS event_time
        FROM trades GROUP BY 1, 2""",
    "last_hundred": """
        SELECT s AS symbol, t, seq, count(*) OVER w::DOUBLE AS batch_trade_count, avg(p) OVER w AS price_mean,
               CASE WHEN min(p) OVER w < max(p) OVER w THEN stddev_pop(p) OVER w ELSE 0 END AS price_std,
               min(p) OVER w AS price_min, max(p) OVER w AS price_max, sum(v) OVER w AS volume_sum,
               avg(v) OVER w AS volume_mean, max(v) OVER w AS volume_max,
               (p - first_value(p) OVER w) / first_value(p) OVER w * 100 AS price_change_pct
        FROM trades WINDOW w AS (PARTITION BY s ORDER BY t, seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
    # A made-up decision value per feature row, so that scaling and evaluation can be compared.
    "decided": """
        SELECT symbol, bucket, round_even(price_change_pct / 100 - volume_max / 1000, 6) AS raw FROM features""",
    "scored": """
        SELECT symbol, bucket, raw, round_even((hi - raw) / (hi - lo), 6) AS score
        FROM decided CROSS JOIN (SELECT min(raw) AS lo, max(raw) AS hi FROM decided)""",
}
for _name, _cooldown_ms in (
    ("volume", C.volume_cooldown_ms),
    ("volatility", C.volatility_cooldown_ms),
    ("momentum", C.momentum_cooldown_ms),
):
    _ranked, _chain, _kept = _cooldown(f"{_name}_cands", _cooldown_ms)
    CTES[f"{_name}_cands_ranked"], CTES[f"{_name}_cands_chain"], CTES[f"{_name}_kept"] = _ranked, _chain, _kept


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", text))
    return [name for name in CTES if name in words]


def with_ctes(text: str) -> str:
    """Prefix a query with the definitions it uses, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in _needs(CTES[name]):
            if other != name:
                visit(other)
        order.append(name)

    for name in _needs(text):
        visit(name)
    if not order:
        return text
    heads = [f"{n}{'(symbol, rn, last_fire, kept)' if n.endswith('_chain') else ''} AS ({CTES[n]})" for n in order]
    body = text.strip()
    if body.startswith("WITH "):
        heads.append(body[len("WITH ") :])
        return "WITH RECURSIVE " + ",\n".join(heads)
    return "WITH RECURSIVE " + ",\n".join(heads) + "\n" + body


# ---- wire fixtures: what the dirty feed of queries.py contains ---------------------------------------

WIRE = f"""
    SELECT event_id AS seq, event_id % 50 AS d, event_id // 5 AS frame,
           max(epoch_us(ts) // 1000) OVER (PARTITION BY event_id // 5) AS received,
           event_type, value, 100.0::DOUBLE + k * k * k * k / 1e6::DOUBLE AS price
    FROM (SELECT *, regexp_extract(props, '"k": *([0-9]+)', 1)::DOUBLE AS k FROM events)"""
WIRE_TRADES = f"""
    SELECT seq, frame, received, CASE WHEN d = 1 THEN 'nobody' ELSE event_type END AS s,
           CASE WHEN d = 2 THEN NULL WHEN d = 3 THEN 0.0 WHEN d = 4 THEN -price ELSE price END AS p,
           CASE WHEN d = 5 THEN NULL WHEN d = 6 THEN -1.0 ELSE value END AS v,
           CASE WHEN d = 7 THEN NULL WHEN d = 8 THEN received - 60001 WHEN d = 9 THEN received - 60000
                ELSE received - 1000 * (seq % 5) END AS t
    FROM ({WIRE}) WHERE d NOT IN (10, 11, 12)"""
REASON = """
    CASE WHEN s = 'nobody' THEN 'unknown_symbol' WHEN p IS NULL THEN 'missing_price' WHEN p <= 0 THEN 'bad_price'
         WHEN v IS NULL THEN 'missing_volume' WHEN v < 0 THEN 'bad_volume' WHEN t IS NULL THEN 'missing_time'
         WHEN received - t > 60000 THEN 'stale' END"""

# What happens to signal records on the wire, by arrival number (see `wire_signals` in queries.py).
SIGNAL_WIRE = """
    SELECT 'volume_spike' AS kind, symbol, trade_ts, seq, price AS shown FROM volume_kept
    UNION ALL SELECT 'momentum_signal', symbol, trade_ts, seq, latest_close FROM momentum_kept
    UNION ALL SELECT 'volatility_spike', symbol, trade_ts, seq, price FROM volatility_kept"""
SIGNAL_ERROR = """
    CASE WHEN seq % 13 = 0 THEN 'bad_json' WHEN seq % 11 = 0 THEN 'unknown_type'
         WHEN seq % 7 = 0 AND kind = 'momentum_signal' THEN 'direction'
         WHEN seq % 7 = 0 THEN 'price'
         WHEN seq % 17 = 0 THEN 'ml_anomaly_score' END"""

_PREFIX = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SIGNAL_PREFIX.items()) + " END"
_SILVER_PATH = (
    f"'silver/' || {_PREFIX} || '/' || strftime({ts('trade_ts')}, '%Y/%m/%d') || '/' || "
    f"strftime({ts('trade_ts')}, '%Y-%m-%dT%H-%M-%S.') || lpad((trade_ts % 1000)::VARCHAR, 3, '0') || 'Z_' || symbol || '.json'"
)


def _pnl(low: int, high: int) -> str:
    return (
        "(SELECT arg_min(later.last_price, later.snapshot_ms) FROM snapshots later WHERE later.symbol = spike.symbol "
        f"AND later.snapshot_ms - spike.trade_ts BETWEEN {low} AND {high})"
    )


_WIN = "(exit_price - price) / price * 100"
_WIN_COLS = f"""round(100.0 * sum(CASE WHEN {_WIN} >= 1.0 THEN 1 ELSE 0 END) / count(*), 1) AS win_rate_pct,
    round(avg({_WIN}), 3) AS avg_return_pct"""


def _feature_out(extra: str) -> str:
    return f"""symbol, {extra}, batch_trade_count, {r4("price_mean")} AS price_mean, {r4("price_std")} AS price_std,
        price_min, price_max, {r4("volume_sum")} AS volume_sum, {r4("volume_mean")} AS volume_mean, volume_max,
        {r4("price_change_pct")} AS price_change_pct"""


_GOLD_OUT = {
    "volume": f"""timestamp, detected_at, symbol, price, trade_volume, avg_volume, spike_ratio, window_trade_count,
        window_span_secs, ml_anomaly_score""",
    "momentum": f"""{ts("window_end_ts")} AS window_end_ts, {ts("window_start_ts")} AS window_start_ts, detected_at, symbol,
        direction, candles_in_direction, total_candles, oldest_open, latest_close, pct_change, ml_anomaly_score""",
    "volatility": """timestamp, detected_at, symbol, price, mean_price, std_dev, z_score, window_trade_count,
        window_span_secs, ml_anomaly_score""",
    "sector": f"""snapshot_ts, symbol, last_price, open_price, pct_change, trade_count,
        {r4("total_volume")} AS total_volume, {ts("last_trade_ts")} AS last_trade_ts, is_stale""",
}
_SNAP_TEXT = """strftime(make_timestamp(snapshot_ms * 1000), '%Y-%m-%dT%H:%M:%S.000Z')"""

_REPORT = f"""
    SELECT {he("avg((score > 0.5)::INT)", 4)} AS anomaly_rate, {he("quantile_cont(score, 0.5)", 4)} AS score_p50,
           {he("quantile_cont(score, 0.9)", 4)} AS score_p90, {he("quantile_cont(score, 0.99)", 4)} AS score_p99,
           count(*) AS n_records FROM scored"""

RETENTION_AS_OF = "DATE '2024-04-10'"

SQL: dict[str, str] = {
    # ingest
    "frame_parse": f"SELECT frame, s, p, v, coalesce(t, -1) AS t FROM ({WIRE_TRADES})",
    "valid_trades": f"SELECT s, p, v, t FROM ({WIRE_TRADES}) WHERE {REASON} IS NULL",
    "reject_report": f"SELECT s, {REASON} AS reason, count(*) AS n FROM ({WIRE_TRADES}) WHERE {REASON} IS NOT NULL GROUP BY 1, 2",
    "frame_type_counts": f"""
        SELECT kind, count(*) AS n FROM (
            SELECT DISTINCT 'trade' AS kind, frame FROM ({WIRE_TRADES})
            UNION ALL SELECT CASE d WHEN 10 THEN 'invalid' WHEN 11 THEN 'ping' ELSE 'other' END, seq FROM ({WIRE})
            WHERE d IN (10, 11, 12)) GROUP BY 1""",
    "envelope_decode": """
        SELECT s, p, v, t FROM trades WHERE seq % 50 NOT IN (10, 11)""",
    "signal_validate": f"SELECT kind, symbol, trade_ts, {SIGNAL_ERROR} AS error FROM ({SIGNAL_WIRE})",
    "session_filter": f"""
        SELECT s, p, v, t FROM (SELECT *, {ts("t")} - INTERVAL 5 HOUR AS local FROM trades)
        WHERE isodow(local) < 6 AND hour(local) * 60 + minute(local) >= 570 AND hour(local) * 60 + minute(local) < 960""",
    "bronze_recent_scan": f"""
        SELECT s, p, v, t FROM trades WHERE t >= {ms(NOW)} - {C.warm_start_ms} AND t <= {ms(NOW)} + 999""",
    "bronze_lookback_scan": f"SELECT s, p, v, t FROM trades WHERE t >= {ms(NOW)} - 14 * 86400000",
    "retention_expired": f"""
        WITH days AS (SELECT {ts("t")}::DATE AS date, count(*) AS n FROM trades GROUP BY 1)
        SELECT layer, date::VARCHAR AS date, n FROM days CROSS JOIN (VALUES ('bronze', 90), ('silver', 90), ('features', 30)) l(layer, keep)
        WHERE date < {RETENTION_AS_OF} - keep""",
    # medallion
    "silver_route": f"""
        SELECT {_SILVER_PATH} AS path, kind AS signal_type, {ts("trade_ts")}::DATE::VARCHAR AS date,
               CASE WHEN seq % 3 = 0 THEN seq + 1000000000 ELSE seq END AS arrival,
               CASE WHEN seq % 3 = 0 THEN shown + 1 ELSE shown END AS shown
        FROM ({SIGNAL_WIRE}) WHERE {SIGNAL_ERROR} IS NULL""",
    "silver_read_typed": f"""
        SELECT kind AS signal_type, symbol, trade_ts, shown FROM ({SIGNAL_WIRE})
        WHERE {SIGNAL_ERROR} IS NULL AND seq % 5 NOT IN (0, 1)""",
    "gold_upsert_volume": """
        SELECT detected_at, symbol, spike_ratio, CASE WHEN trade_ts % 2 = 0 THEN 'old' ELSE 'first' END AS origin FROM volume_spikes""",
    "gold_upsert_momentum": f"""
        SELECT {ts("window_end_ts")} AS window_end_ts, symbol, pct_change,
               CASE WHEN trade_ts % 2 = 0 THEN 'old' ELSE 'first' END AS origin FROM momentum_signals""",
    "gold_upsert_volatility": """
        SELECT detected_at, symbol, z_score, CASE WHEN trade_ts % 2 = 0 THEN 'old' ELSE 'first' END AS origin FROM volatility_spikes""",
    "gold_upsert_sector": """
        SELECT snapshot_ts, symbol, trade_count,
               CASE WHEN trade_count % 2 = 0 THEN 'old' ELSE 'first' END AS origin FROM sector_snapshots""",
    "gold_volume_spikes": f"SELECT {_GOLD_OUT['volume']} FROM volume_spikes",
    "gold_momentum_signals": f"SELECT {_GOLD_OUT['momentum']} FROM momentum_signals",
    "gold_volatility_spikes": f"SELECT {_GOLD_OUT['volatility']} FROM volatility_spikes",
    "gold_sector_snapshots": f"SELECT {_GOLD_OUT['sector']} FROM sector_snapshots",
    # detectors
    "rolling_window_stats": f"""
        SELECT s, t, seq, w_count, w_from, {r4("w_volume")} AS w_volume, {r4("w_mean")} AS w_price_mean,
               {r4("CASE WHEN w_low < w_high THEN sqrt(w_var) ELSE 0 END")} AS w_price_std FROM rolled""",
    "volume_spike_candidates": "SELECT * FROM volume_cands",
    "volume_spikes": "SELECT * FROM volume_kept",
    "volatility_spike_candidates": "SELECT * FROM volatility_cands",
    "volatility_spikes": "SELECT * FROM volatility_kept",
    "candles": f"SELECT s, minute, open, high, low, close, {r4("volume")} AS volume, first_t, first_seq FROM bars",
    "completed_candles": f"""
        SELECT s, minute, open, high, low, close, {r4("volume")} AS volume, first_t, close_t FROM completed""",
    "late_trade_filter": f"""
        SELECT s, t, seq, coalesce(minute < max(minute) OVER w, false) AS is_late
        FROM (SELECT *, t // {C.candle_ms} AS minute, (t + (seq * 7919 % 1000) * 20000) * 1048576 + seq % 1048576 AS arrival
              FROM trades)
        WINDOW w AS (PARTITION BY s ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "momentum_candidates": "SELECT * FROM momentum_cands",
    "momentum_signals": "SELECT * FROM momentum_kept",
    "cooldown_thin": "SELECT symbol, trade_ts, seq FROM thin_cands_kept",
    "sector_state": f"""
        SELECT s, t, seq, open_price, p AS last_price, trade_count, {r4("total_volume")} AS total_volume,
               {he("(p - open_price) / open_price * 100", 3)} AS pct_change
        FROM (SELECT *, first_value(p) OVER w AS open_price, count(*) OVER w AS trade_count, sum(v) OVER w AS total_volume
              FROM trades WINDOW w AS (PARTITION BY s ORDER BY t, seq ROWS UNBOUNDED PRECEDING))""",
    "sector_snapshots": f"SELECT * REPLACE ({r4("total_volume")} AS total_volume) FROM snapshots",
    "sector_snapshot_nested": f"""
        SELECT {_SNAP_TEXT} AS snapshot_ts, count(*) AS n,
               string_agg(symbol || ':' || trade_count || ':' || coalesce(last_trade_ts::VARCHAR, '-'), '|' ORDER BY symbol) AS symbols
        FROM snapshots GROUP BY 1""",
    "sector_snapshot_explode": f"""
        SELECT {_SNAP_TEXT} AS snapshot_ts, symbol, last_price, open_price, pct_change, trade_count,
               {r4("total_volume")} AS total_volume, last_trade_ts, is_stale FROM snapshots""",
    "session_reset": f"""
        WITH marked AS (
            SELECT *, coalesce(t - lag(t) OVER (PARTITION BY s ORDER BY t, seq) > 6000000, false)::INT AS brk FROM trades),
        numbered AS (SELECT *, sum(brk) OVER (PARTITION BY s ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS sid FROM marked),
        windowed AS (
            SELECT *, count(*) OVER w AS w_count, min(t) OVER w AS w_from, sum(v) OVER w AS w_volume FROM numbered
            WINDOW w AS (PARTITION BY s, sid ORDER BY t RANGE BETWEEN {C.volume_window_ms} PRECEDING AND CURRENT ROW))
        SELECT s AS symbol, sid::BIGINT AS session_id, t AS trade_ts, {he("v / m", 2)} AS spike_ratio,
               w_count::INT AS window_trade_count
        FROM (SELECT *, (w_volume - v) / (w_count - 1) AS m FROM windowed WHERE w_count >= 2)
        WHERE t - w_from >= {C.volume_min_span_ms} AND m > 0 AND v >= m * 2.0::DOUBLE - 5e-10""",
    "all_signals": f"""
        SELECT symbol, {ts("trade_ts")} AS detected_at, 'volume_spike' AS signal_type, spike_ratio AS strength, price, trade_ts, seq
        FROM volume_kept
        UNION ALL SELECT symbol, {ts("trade_ts")}, 'momentum_signal', abs(pct_change), latest_close, trade_ts, seq FROM momentum_kept
        UNION ALL SELECT symbol, {ts("trade_ts")}, 'volatility_spike', z_score, price, trade_ts, seq FROM volatility_kept""",
    # reports
    "q_market_breadth": """
        SELECT symbol, pct_change, last_price, is_stale FROM sector_snapshots
        WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM sector_snapshots)""",
    "q_signal_clusters": f"""
        SELECT {ts(f"{ms('detected_at')} // {C.cluster_ms} * {C.cluster_ms}")} AS bucket,
               count(DISTINCT symbol) AS symbol_count, count(*) AS signal_count
        FROM fired WHERE detected_at::DATE = {TODAY} AND detected_at >= {NOW} - INTERVAL {C.cluster_lookback_ms} MILLISECOND
        GROUP BY 1 HAVING count(DISTINCT symbol) >= 3""",
    "q_session_leaderboard": f"""
        SELECT symbol, count(*) AS signal_count FROM fired WHERE detected_at::DATE = {TODAY}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "q_opening_range": "SELECT * FROM opening",
    "q_all_realtime_signals": "SELECT * FROM live",
    "q_rvol": f"SELECT hour, today_count, {r4("hist_avg")} AS hist_avg, {r4("rvol")} AS rvol FROM rvol",
    "q_best_hours": f"""
        SELECT hour(detected_at) AS hour, count(*) AS signal_count, {r4("avg(spike_ratio)")} AS avg_ratio,
               max(spike_ratio) AS max_ratio
        FROM volume_spikes WHERE detected_at::DATE = {THAT_DAY} GROUP BY 1""",
    "q_signal_strength": f"""
        SELECT CASE WHEN spike_ratio < 5 THEN 'Mild (4-5x)' WHEN spike_ratio < 8 THEN 'Moderate (5-8x)'
                    WHEN spike_ratio < 12 THEN 'Strong (8-12x)' ELSE 'Extreme (12x+)' END AS bucket,
               count(*) AS signal_count, {r4("avg(abs(pct_change))")} AS avg_abs_move
        FROM banded GROUP BY 1""",
    "q_multi_signal_confirmation": f"""
        SELECT vs.symbol, vs.detected_at AS vol_time, m.detected_at AS mom_time,
               {secs("m.detected_at")} - {secs("vs.detected_at")} AS seconds_apart, vs.spike_ratio, m.direction
        FROM volume_spikes vs JOIN momentum_signals m ON m.symbol = vs.symbol
         AND abs({secs("m.detected_at")} - {secs("vs.detected_at")}) <= {C.confirm_ms // 1000}
        WHERE vs.detected_at::DATE = {THAT_DAY}""",
    "q_stock_correlation": "SELECT * FROM pairs",
    "q_volatility_regime": f"""
        SELECT date_trunc('day', detected_at)::TIMESTAMP AS day, count(*) AS signal_count, {r4("avg(z_score)")} AS avg_z,
               max(z_score) AS max_z
        FROM volatility_spikes WHERE detected_at >= {TODAY} - INTERVAL 7 DAY GROUP BY 1""",
    "q_sector_rotation": f"""
        SELECT hour(detected_at) AS hour, 'volume' AS signal_type, count(*) AS cnt FROM volume_spikes
        WHERE detected_at::DATE = {THAT_DAY} GROUP BY 1
        UNION ALL SELECT hour(detected_at), 'momentum', count(*) FROM momentum_signals
        WHERE detected_at::DATE = {THAT_DAY} GROUP BY 1
        UNION ALL SELECT hour(detected_at), 'volatility', count(*) FROM volatility_spikes
        WHERE detected_at::DATE = {THAT_DAY} GROUP BY 1""",
    "q_signal_accuracy": f"""
        SELECT count(*) AS total_signals, sum(CASE WHEN {_WIN} >= 1.0 THEN 1 ELSE 0 END)::BIGINT AS wins, {_WIN_COLS},
               sum(CASE WHEN {_WIN} >= 2.0 THEN 1 ELSE 0 END)::BIGINT AS wins_2pct
        FROM returns WHERE exit_price IS NOT NULL""",
    "q_symbol_win_rates": f"""
        SELECT symbol, count(*) AS total, {_WIN_COLS} FROM (
            SELECT symbol, price, avg(last_price) AS exit_price FROM banded WHERE spike_ratio >= 4.0 GROUP BY ALL)
        WHERE exit_price IS NOT NULL GROUP BY 1 HAVING count(*) >= 3""",
    "q_per_signal_pnl": f"""
        SELECT symbol, detected_at, price AS entry_price, spike_ratio,
               {_pnl(C.pnl_5_from_ms, C.pnl_5_to_ms)} AS exit_5min, {_pnl(C.pnl_15_from_ms, C.pnl_15_to_ms)} AS exit_15min,
               {_pnl(C.pnl_30_from_ms, C.pnl_30_to_ms)} AS exit_30min, ml_anomaly_score
        FROM volume_spikes spike WHERE detected_at >= {TODAY} - INTERVAL 30 DAY
        ORDER BY detected_at DESC, symbol LIMIT 200""",
    "q_ml_score_distribution": "SELECT ml_anomaly_score, signal_type FROM scores",
    "q_ml_score_vs_strength": """
        SELECT symbol, strength, ml_anomaly_score, signal_type FROM scores WHERE signal_type <> 'momentum_signal'""",
    "q_ml_confirmed_signals": """
        SELECT symbol, detected_at, strength, ml_anomaly_score, price, signal_type FROM scores WHERE ml_anomaly_score >= 0.75""",
    # what the screen derives
    "q_symbol_filter": "SELECT * FROM live WHERE symbol IN ('click', 'view')",
    "q_breadth_verdict": """
        SELECT up, down, flat, CASE WHEN up > down + 2 THEN 'BULLISH' WHEN down > up + 2 THEN 'BEARISH' ELSE 'MIXED' END AS verdict
        FROM (SELECT count(*) FILTER (pct_change > 0) AS up, count(*) FILTER (pct_change < 0) AS down,
                     count(*) FILTER (coalesce(pct_change, 0) = 0) AS flat
              FROM sector_snapshots WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM sector_snapshots))""",
    "q_signal_score": "SELECT *, {score} AS score FROM live",
    "q_top_active": """
        SELECT *, {score} AS score, CASE WHEN ml_anomaly_score IS NULL THEN 'N/A' ELSE format('{{:.2f}}', ml_anomaly_score) END AS ml_text
        FROM live ORDER BY score DESC, detected_at DESC, symbol, signal_type LIMIT 5""",
    "q_signal_mix": "SELECT signal_type, count(*) AS n FROM live GROUP BY 1",
    "q_orb_breakouts": "SELECT * FROM opening WHERE orb_status <> 'IN_RANGE'",
    "q_rvol_colored": f"""
        SELECT hour, today_count, {r4("hist_avg")} AS hist_avg, {r4("rvol")} AS rvol,
               CASE WHEN rvol >= 1.5 THEN 'green' WHEN rvol >= 1.0 THEN 'orange' ELSE 'red' END AS color FROM rvol""",
    "q_top_pairs": """
        SELECT symbol_a || '/' || symbol_b AS pair, co_signal_count FROM pairs
        ORDER BY co_signal_count DESC, symbol_a, symbol_b LIMIT 10""",
    "q_ml_confirmed_live": "SELECT * FROM live WHERE coalesce(ml_anomaly_score, 0) >= 0.75",
    "q_ml_score_percentiles": f"""
        SELECT {r4("quantile_cont(ml_anomaly_score, 0.5)")} AS p50, {r4("quantile_cont(ml_anomaly_score, 0.9)")} AS p90
        FROM scores""",
    "q_ml_score_histogram": """
        SELECT signal_type, least(20, floor(ml_anomaly_score * 20)::BIGINT + 1) AS bin, count(*) AS n FROM scores GROUP BY 1, 2""",
    # features and evaluation
    "feature_windows": f"SELECT {_feature_out('event_time')} FROM features",
    "feature_last100": f"SELECT {_feature_out('t, seq')} FROM last_hundred",
    "feature_at_signals": f"""
        SELECT {_feature_out('t, seq')} FROM last_hundred JOIN (
            SELECT symbol, trade_ts AS t, seq FROM volume_kept UNION SELECT symbol, trade_ts, seq FROM momentum_kept
            UNION SELECT symbol, trade_ts, seq FROM volatility_kept) USING (symbol, t, seq)""",
    "feature_batch": f"""
        SELECT {_feature_out("batch_id, event_time")} FROM (
            SELECT s AS symbol, seq // 100 AS batch_id, count(*)::DOUBLE AS batch_trade_count,
                   avg(p) AS price_mean, stddev_pop(p) AS price_std, min(p) AS price_min, max(p) AS price_max,
                   sum(v) AS volume_sum, avg(v) AS volume_mean, max(v) AS volume_max,
                   (last(p ORDER BY t, seq) - first(p ORDER BY t, seq)) / first(p ORDER BY t, seq) * 100 AS price_change_pct,
                   strftime({ts("max(t)")}, '%Y-%m-%dT%H:%M:%SZ') AS event_time
            FROM trades GROUP BY 1, 2)""",
    "feature_split": f"""
        SELECT symbol, event_time, batch_trade_count,
               CASE WHEN max_t >= {ms(NOW)} - 2 * 86400000 THEN 'validation' ELSE 'train' END AS split FROM features""",
    "score_minmax": "SELECT symbol, bucket, score FROM scored",
    "ml_eval_report": f"""
        SELECT r.*, (SELECT string_agg(symbol || '=' || printf('%.4f', rate), ',' ORDER BY symbol) FROM (
            SELECT symbol, {he("avg((score > 0.5)::INT)", 4)} AS rate FROM scored GROUP BY 1)) AS symbol_rates
        FROM ({_REPORT}) r""",
    "ml_eval_by_symbol": f"""
        SELECT symbol, {he("avg((score > 0.5)::INT)", 4)} AS anomaly_rate, count(*) AS n_records FROM scored GROUP BY 1""",
    "ml_gate": f"""
        SELECT anomaly_rate, anomaly_rate BETWEEN 0.03 AND 0.20 AS passed,
               CASE WHEN anomaly_rate BETWEEN 0.03 AND 0.20 THEN 'PendingManualApproval' ELSE 'Rejected' END AS status
        FROM ({_REPORT})""",
    "iforest_fit": f"""
        SELECT tree::INT AS tree, least(256, n) AS sample_size, least(256, n) AS leaf_rows, true AS is_full, true AS within_depth
        FROM range(200) r(tree) CROSS JOIN (
            SELECT count(*) AS n FROM features WHERE max_t < {ms(NOW)} - 2 * 86400000)""",
    "iforest_score": """
        SELECT symbol, event_time, true AS agrees, true AS on_top FROM features
        UNION ALL SELECT DISTINCT symbol, 'planted', true, true FROM features""",
    "signals_scored": """
        SELECT 'volume_spike' AS signal_type, symbol, trade_ts, seq, true AS agrees FROM volume_kept
        UNION ALL SELECT 'momentum_signal', symbol, trade_ts, seq, true FROM momentum_kept
        UNION ALL SELECT 'volatility_spike', symbol, trade_ts, seq, true FROM volatility_kept""",
    "model_registry": f"""
        SELECT row_number() OVER (ORDER BY hours) AS version, anomaly_rate,
               CASE WHEN hours = 2 THEN 'Approved' ELSE 'PendingManualApproval' END AS status,
               CASE WHEN hours = 2 THEN {NOW} + INTERVAL 1 DAY ELSE {NOW} + to_hours(hours) END AS created_at
        FROM (SELECT unnest(range(6))::INT AS hours,
                     unnest([anomaly_rate, 0.03::DOUBLE, 0.1::DOUBLE, 0.2::DOUBLE, round(anomaly_rate + 0.2, 4), 0.0299::DOUBLE])
                     AS anomaly_rate
              FROM ({_REPORT}))
        WHERE anomaly_rate BETWEEN 0.03 AND 0.20""",
    "iforest_roundtrip": "SELECT symbol, event_time, true AS equal FROM features",
}

_SCORE = """CASE signal_type WHEN 'volume_spike' THEN greatest(1, least(10, trunc(strength / 0.5::DOUBLE)::INT))
    WHEN 'volatility_spike' THEN greatest(1, least(10, trunc(strength / 0.3::DOUBLE)::INT))
    WHEN 'momentum_signal' THEN greatest(1, least(10, trunc(abs(strength) / 0.15::DOUBLE)::INT)) ELSE 5 END"""
for _key in ("q_signal_score", "q_top_active"):
    SQL[_key] = SQL[_key].format(score=_SCORE)

# A denser candidate stream for the cooldown alone: every trade.
CTES["thin_cands"] = "SELECT s AS symbol, t AS trade_ts, seq FROM trades"
_ranked, _chain, _kept = _cooldown("thin_cands", C.volume_cooldown_ms)
CTES["thin_cands_ranked"], CTES["thin_cands_chain"], CTES["thin_cands_kept"] = _ranked, _chain, _kept

# The detectors on other trades: restarted at the start of DAY with their lookback replayed, and by session.
_START = f"epoch_us({THAT_DAY}::TIMESTAMP) // 1000"
CTES["replay_trades"] = f"SELECT * FROM trades WHERE t >= {_START} - {C.warm_start_ms}"
CTES["session_trades"] = """
    SELECT s || '#' || sum(brk) OVER (PARTITION BY s ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS s, p, v, t, seq
    FROM (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY s ORDER BY t, seq) > 6000000, false)::INT AS brk FROM trades)"""
_STEPS = ("rolled", "volume_cands", "volatility_cands", "bars", "completed", "momentum_cands", "last_hundred", "snapshots")
for _kind in ("replay", "session"):
    for _step in _STEPS:
        CTES[f"{_kind}_{_step}"] = re.sub(rf"\b({'|'.join(('trades', *_STEPS))})\b", rf"{_kind}_\1", CTES[_step])
    for _name, _cooldown_ms in (
        ("volume", C.volume_cooldown_ms),
        ("volatility", C.volatility_cooldown_ms),
        ("momentum", C.momentum_cooldown_ms),
    ):
        _cands = f"{_kind}_{_name}_cands"
        CTES[f"{_cands}_ranked"], CTES[f"{_cands}_chain"], CTES[f"{_kind}_{_name}_kept"] = _cooldown(_cands, _cooldown_ms)


def _every_kind(kind: str, columns: str) -> str:
    return f"""
        SELECT 'volume_spike' AS signal_type, {columns}, spike_ratio, NULL::DOUBLE AS pct_change, NULL::DOUBLE AS z_score
        FROM {kind}_volume_kept
        UNION ALL SELECT 'momentum_signal', {columns}, NULL, pct_change, NULL FROM {kind}_momentum_kept
        UNION ALL SELECT 'volatility_spike', {columns}, NULL, NULL, z_score FROM {kind}_volatility_kept"""


SQL["warm_start_replay"] = f"SELECT * FROM ({_every_kind('replay', 'symbol, trade_ts, seq')}) WHERE trade_ts >= {_START}"
SQL["session_signals"] = f"""
    SELECT * REPLACE (split_part(symbol, '#', 1) AS symbol), split_part(symbol, '#', 2)::BIGINT AS session_id
    FROM ({_every_kind('session', 'symbol, trade_ts, seq')})"""
SQL["warm_start_snapshots"] = f"""
    SELECT * REPLACE ({r4("total_volume")} AS total_volume) FROM replay_snapshots WHERE snapshot_ms >= {_START}"""
SQL["session_features"] = f"""
    SELECT * REPLACE (split_part(symbol, '#', 1) AS symbol), split_part(symbol, '#', 2)::BIGINT AS session_id
    FROM (SELECT {_feature_out('t, seq')} FROM session_last_hundred JOIN (
        SELECT symbol, trade_ts AS t, seq FROM session_volume_kept UNION SELECT symbol, trade_ts, seq FROM session_momentum_kept
        UNION SELECT symbol, trade_ts, seq FROM session_volatility_kept) USING (symbol, t, seq))"""
SQL["session_snapshots"] = f"""
    WITH folds AS (
        SELECT split_part(s, '#', 1) AS s, split_part(s, '#', 2)::BIGINT AS sid, (t + {C.snapshot_ms - 1}) // {C.snapshot_ms} AS tick,
               first(p ORDER BY t, seq) AS open_p, last(p ORDER BY t, seq) AS last_p, count(*) AS n, sum(v) AS vol, max(t) AS last_t
        FROM session_trades GROUP BY ALL),
    grid AS (
        SELECT s, unnest(range(lo, hi + 1)) AS tick FROM (SELECT DISTINCT s FROM folds)
        CROSS JOIN (SELECT min(t) // {C.snapshot_ms} + 1 AS lo, max(t) // {C.snapshot_ms} AS hi FROM trades)),
    present AS (
        SELECT g.*, f.* EXCLUDE (s, tick), max(sid) OVER (PARTITION BY g.s ORDER BY g.tick) AS cur
        FROM grid g LEFT JOIN folds f USING (s, tick)),
    summed AS (
        SELECT s, tick, first_value(open_p IGNORE NULLS) OVER w AS open_price, last_value(last_p IGNORE NULLS) OVER w AS last_price,
               sum(n) OVER w AS n, sum(vol) OVER w AS vol, max(last_t) OVER w AS last_t
        FROM present WHERE cur IS NOT NULL
        WINDOW w AS (PARTITION BY s, cur ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    unbroken AS (SELECT * FROM summed WHERE tick * {C.snapshot_ms} - last_t <= 6000000)
    SELECT g.tick * {C.snapshot_ms} AS snapshot_ms, g.s AS symbol, last_price, open_price,
           {he("(last_price - open_price) / open_price * 100", 3)} AS pct_change, coalesce(n, 0)::INT AS trade_count,
           {r4("coalesce(vol, 0.0)")} AS total_volume, last_t AS last_trade_ts,
           coalesce(g.tick * {C.snapshot_ms} - last_t > {C.stale_ms}, false) AS is_stale
    FROM grid g LEFT JOIN unbroken l ON l.s = g.s AND l.tick = g.tick"""
SQL["bronze_candles"] = f"""
    SELECT * REPLACE ({r4("volume")} AS volume) FROM archived_bars"""
CTES["archived_trades"] = f"SELECT * FROM trades WHERE t >= {ms(NOW)} - 14 * 86400000 AND t < {ms(NOW)} + 3600000 + 3600000"
CTES["archived_bars"] = re.sub(r"\btrades\b", "archived_trades", CTES["bars"])
SQL["model_registry_forest"] = f"""
    SELECT symbol, count(*) AS n_records, true AS agrees FROM features WHERE max_t >= {ms(NOW)} - 2 * 86400000 GROUP BY 1"""
SQL["q_ml_confirmed_by_forest"] = f"""
    SELECT signal_type, symbol, detected_at, true AS agrees FROM feed WHERE detected_at::DATE = {THAT_DAY}"""


def oracle_sql() -> dict[str, str]:
    return {key: with_ctes(text) for key, text in SQL.items()}
