"""Per-symbol state of the streaming detectors.

A symbol's new trades of one micro-batch are worked on as arrays together with the tail of its window, so the
cost of a batch is the size of that tail plus the batch. The size of a batch is set at the source.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from datetime import datetime, timezone
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tradeloom.config import Settings
from tradeloom.operators.cooldown import kept_positions
from tradeloom.operators.detectors import MEAN_NOISE, SPREAD_NOISE
from tradeloom.schemas import FEATURE_COLS

_NEVER = -(2**62)

Plugin = Callable[[str, np.ndarray, np.ndarray, np.ndarray, dict], list[dict]]


def iso(ms: int) -> str:
    at = datetime.fromtimestamp(ms // 1000, timezone.utc)
    return f"{at:%Y-%m-%dT%H:%M:%S}.{ms % 1000:03d}Z"


def stable_round(x: float, digits: int) -> float:
    """Half to even on the decimal digits, as ``functions.columns.half_even``."""
    return float(Decimal(repr(round(float(x), 9))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_EVEN))


def in_order(chunks: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Time, price, volume and arrival number of a batch's trades, in order of time and arrival."""
    new = pd.concat(list(chunks), ignore_index=True).sort_values(["t", "seq"], kind="stable")
    return tuple(new[c].to_numpy(dtype=d) for c, d in (("t", np.int64), ("p", float), ("v", float), ("seq", np.int64)))


def trailing(t: np.ndarray, p: np.ndarray, v: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """Window statistics of every row of time-sorted arrays; a window is ``[t - width, t]`` up to the row."""
    here = np.arange(len(t))
    start = np.searchsorted(t, t - width, side="left")
    n = here - start + 1
    volume = np.concatenate([[0.0], np.cumsum(v)])
    centre = p.mean() if len(p) else 0.0
    off = np.concatenate([[0.0], np.cumsum(p - centre)])
    square = np.concatenate([[0.0], np.cumsum((p - centre) ** 2)])
    mean_off = (off[here + 1] - off[start]) / n
    var = (square[here + 1] - square[start]) / n - mean_off**2
    changed = np.concatenate([[True], p[1:] != p[:-1]]) if len(p) else np.array([], dtype=bool)
    last_change = np.maximum.accumulate(np.where(changed, here, 0))
    return {
        "n": n,
        "from": t[start],
        "prior_volume": volume[here] - volume[start],
        "mean": centre + mean_off,
        # All prices equal when none changed inside the window.
        "var": np.where(last_change <= start, 0.0, np.maximum(var, 0.0)),
    }


def describe(p: np.ndarray, v: np.ndarray) -> dict[str, float]:
    """The features of some trades in time order, as ``operators.features``."""
    n, first = len(p), p[0]
    numbers = (
        n, p.mean(), p.std() if p.min() < p.max() else 0.0, p.min(), p.max(), v.sum(), v.mean(), v.max(),
        (p[-1] - first) / first * 100 if first != 0 else 0.0,
    )
    return dict(zip(FEATURE_COLS, map(float, numbers)))


class SignalProcessor(StatefulProcessor):
    """Volume, volatility and momentum signals of one symbol, each with the features of the latest trades.

    ``plugins`` adds detectors by signal type: ``find(symbol, t, p, v, state)`` gets a batch's trades in order and a
    dictionary that it may change, kept as JSON, and returns the fields of each signal with ``row``, its trade.

    With ``gap_ms`` everything starts anew, plugins and the latest trades included, after a silence longer than that. A timer
    also clears the state of a symbol that stays silent.
    """

    def __init__(
        self, cfg: Settings, columns: list[str], plugins: Mapping[str, Plugin] | None = None, gap_ms: int | None = None
    ):
        self.cfg, self.columns, self.plugins, self.gap_ms = cfg, columns, dict(plugins or {}), gap_ms
        self.width = max(cfg.volume_window_ms, cfg.volatility_window_ms)
        self.slice_ms = max(self.width // 10, 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        # The tail is kept in slices, so that a batch rewrites only the slices it adds to.
        self.tail = handle.getMapState("tail", "slice bigint", "t binary, p binary, v binary")
        self.recent = handle.getValueState("recent", "p binary, v binary")
        self.fired = handle.getValueState("fired", "volume bigint, volatility bigint, momentum bigint")
        self.bars = handle.getValueState(
            "bars",
            "minute bigint, open double, high double, low double, close double, volume double, "
            "minutes array<bigint>, opens array<double>, closes array<double>",
        )
        if self.plugins:
            self.plugged = handle.getMapState("plugins", "signal_type string", "state string")
        if self.gap_ms is not None:
            self.handle = handle
            self.heard = handle.getValueState("heard", "t bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Trades from before the start: they set the state, and their signals are dropped."""
        for _ in self.handleInputRows(key, iter([initialState]), timerValues):
            pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        t, p, v, _ = in_order(rows)
        for start, end, is_new in self._sessions(t):
            if is_new:
                self._clear()
            yield from self._detect(key[0], t[start:end], p[start:end], v[start:end])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.heard.exists() and self.heard.get()[0] + self.gap_ms < timerValues.getCurrentWatermarkInMs():
            self._clear()
            self.heard.clear()
        return iter(())

    def _sessions(self, t: np.ndarray) -> list[tuple[int, int, bool]]:
        """Runs of trades without a silence between them, and whether a silence came before."""
        if self.gap_ms is None:
            return [(0, len(t), False)]
        before = int(self.heard.get()[0]) if self.heard.exists() else None
        newest = np.maximum.accumulate(np.concatenate([[t[0] if before is None else before], t]))
        starts = [0, *(i for i in np.flatnonzero(t - newest[:-1] > self.gap_ms).tolist() if i), len(t)]
        if before is not None:
            self.handle.deleteTimer(before + self.gap_ms + 1)
        self.heard.update((int(newest[-1]),))
        self.handle.registerTimer(int(newest[-1]) + self.gap_ms + 1)
        return [(a, b, bool(t[a] - newest[a] > self.gap_ms)) for a, b in zip(starts, starts[1:])]

    def _clear(self) -> None:
        for state in (self.tail, self.recent, self.fired, self.bars, *([self.plugged] if self.plugins else [])):
            state.clear()

    def _detect(self, symbol, t, p, v) -> Iterator[pd.DataFrame]:
        fired = self.fired.get() if self.fired.exists() else (None, None, None)
        last = [_NEVER if x is None else int(x) for x in fired]

        out = self._windows(symbol, t, p, v, last) + self._momentum(symbol, t, p, v, last)
        out += self._plugged(symbol, t, p, v)
        self.fired.update(tuple(None if x == _NEVER else x for x in last))
        self._describe(out, p, v)
        if out:
            # As objects, so that absent fields stay null instead of turning into NaN.
            yield pd.DataFrame({c: pd.Series([r.get(c) for r in out], dtype=object) for c in self.columns})

    def _plugged(self, symbol, t, p, v) -> list[dict]:
        out = []
        for kind, find in self.plugins.items():
            state = json.loads(self.plugged.getValue((kind,))[0]) if self.plugged.containsKey((kind,)) else {}
            for found in find(symbol, t, p, v, state):
                row = int(found.pop("row"))
                at = int(t[row])
                fixed = {"signal_type": kind, "symbol": symbol, "trade_ts": at, "detected_at": iso(at), "_row": row}
                out.append(found | fixed)
            self.plugged.updateValue((kind,), (json.dumps(state),))
        return out

    def _describe(self, signals: list[dict], p: np.ndarray, v: np.ndarray) -> None:
        """Add the features of the last trades up to each signal, and keep the last trades of the batch."""
        size = self.cfg.recent_trades
        if self.recent.exists():
            old_p, old_v = (np.frombuffer(b) for b in self.recent.get())
        else:
            old_p = old_v = np.array([])
        p, v = np.concatenate([old_p, p]), np.concatenate([old_v, v])
        for signal in signals:
            end = len(old_p) + signal.pop("_row") + 1
            signal.update(describe(p[max(0, end - size) : end], v[max(0, end - size) : end]))
        self.recent.update((p[-size:].tobytes(), v[-size:].tobytes()))

    def _windows(self, symbol, t, p, v, last) -> list[dict]:
        cfg = self.cfg
        old = [(s[0], *(np.frombuffer(b, d) for b, d in zip(x, (np.int64, float, float)))) for s, x in self.tail.iterator()]
        old.sort(key=lambda e: e[0])
        size = sum(len(e[1]) for e in old)
        all_t, all_p, all_v = (
            np.concatenate([*[e[i] for e in old], arr]) for i, arr in ((1, t), (2, p), (3, v))
        )
        order = np.argsort(all_t, kind="stable")
        is_new = order >= size
        row = order - size
        all_t, all_p, all_v = all_t[order], all_p[order], all_v[order]
        self._store_tail(old, all_t, all_p, all_v, t)

        out = []
        w = trailing(all_t, all_p, all_v, cfg.volume_window_ms)
        open_ = is_new & (w["n"] >= 2) & (all_t - w["from"] >= cfg.volume_min_span_ms)
        mean = w["prior_volume"] / np.maximum(w["n"] - 1, 1)
        hits = np.flatnonzero(open_ & (mean > 0) & (all_v >= mean * cfg.volume_multiplier * (1 - MEAN_NOISE)))
        for i in self._cool(hits, all_t, cfg.volume_cooldown_ms, last, 0):
            out.append(
                self._spike(symbol, "volume_spike", all_t, all_p, w, i)
                | {
                    "_row": int(row[i]),
                    "trade_volume": float(all_v[i]),
                    "avg_volume": stable_round(mean[i], 2),
                    "spike_ratio": stable_round(all_v[i] / mean[i], 2),
                }
            )
        if cfg.volatility_window_ms != cfg.volume_window_ms:
            w = trailing(all_t, all_p, all_v, cfg.volatility_window_ms)
        open_ = is_new & (w["n"] >= 2) & (all_t - w["from"] >= cfg.volatility_min_span_ms) & (w["var"] > 0)
        std = np.sqrt(w["var"])
        z = np.divide(np.abs(all_p - w["mean"]), std, out=np.zeros_like(std), where=std > 0)
        hits = np.flatnonzero(open_ & (z >= cfg.volatility_z * (1 - SPREAD_NOISE)))
        for i in self._cool(hits, all_t, cfg.volatility_cooldown_ms, last, 1):
            out.append(
                self._spike(symbol, "volatility_spike", all_t, all_p, w, i)
                | {
                    "_row": int(row[i]),
                    "mean_price": stable_round(w["mean"][i], 4),
                    "std_dev": stable_round(std[i], 4),
                    "z_score": stable_round(z[i], 3),
                }
            )
        return out

    def _store_tail(self, old, all_t, all_p, all_v, t) -> None:
        first_kept = (all_t[-1] - self.width) // self.slice_ms
        for number, *_ in old:
            if number < first_kept:
                self.tail.removeKey((int(number),))
        slices = all_t // self.slice_ms
        for number in np.unique(t // self.slice_ms):
            if number >= first_kept:
                inside = slices == number
                self.tail.updateValue(
                    (int(number),), tuple(a[inside].tobytes() for a in (all_t, all_p, all_v))
                )

    def _cool(self, hits, t, cooldown, last, which) -> np.ndarray:
        if len(hits) == 0:
            return hits
        free = _NEVER if last[which] == _NEVER else last[which] + cooldown
        kept = hits[kept_positions(t[hits], cooldown, free)]
        if len(kept):
            last[which] = int(t[kept[-1]])
        return kept

    def _spike(self, symbol, kind, t, p, w, i) -> dict:
        at = int(t[i])
        return {
            "signal_type": kind,
            "symbol": symbol,
            "price": float(p[i]),
            "window_trade_count": int(w["n"][i]),
            "window_span_secs": stable_round((at - int(w["from"][i])) / 1000, 1),
            "trade_ts": at,
            "detected_at": iso(at),
        }

    def _momentum(self, symbol, t, p, v, last) -> list[dict]:
        cfg, n = self.cfg, self.cfg.momentum_candles
        current, done = None, []
        if self.bars.exists():
            minute, o, h, low, c, vol, minutes, opens, closes = self.bars.get()
            current, done = [minute, o, h, low, c, vol], list(zip(minutes, opens, closes))
        minute, row = t // cfg.candle_ms, np.arange(len(t))
        if current is not None:
            on_time = minute >= current[0]
            t, p, v, minute, row = t[on_time], p[on_time], v[on_time], minute[on_time], row[on_time]
        out = []
        numbers, starts = np.unique(minute, return_index=True)
        for number, a, b in zip(numbers, starts, [*starts[1:], len(t)]):
            bar = [int(number), float(p[a]), float(p[a:b].max()), float(p[a:b].min()), float(p[b - 1]), float(v[a:b].sum())]
            if current is not None and current[0] == bar[0]:
                current = [bar[0], current[1], max(current[2], bar[2]), min(current[3], bar[3]), bar[4], current[5] + bar[5]]
                continue
            if current is not None:
                done = [*done, (current[0], current[1], current[4])][-n:]
                out += [s | {"_row": int(row[a])} for s in self._direction(symbol, done, int(t[a]), last)]
            current = bar
        if current is not None:
            minutes, opens, closes = (list(x) for x in zip(*done)) if done else ([], [], [])
            self.bars.update((*current, minutes, opens, closes))
        return out

    def _direction(self, symbol, done, at, last) -> list[dict]:
        cfg, n = self.cfg, self.cfg.momentum_candles
        if len(done) < n or (last[2] != _NEVER and at - last[2] < cfg.momentum_cooldown_ms):
            return []
        up = sum(close >= open_ for _, open_, close in done)
        direction, agree = ("UP", up) if up >= cfg.momentum_min_agree else ("DOWN", n - up)
        if agree < cfg.momentum_min_agree:
            return []
        last[2] = at
        (first, oldest, _), (newest, _, close) = done[0], done[-1]
        return [
            {
                "signal_type": "momentum_signal",
                "symbol": symbol,
                "direction": direction,
                "candles_in_direction": agree,
                "total_candles": n,
                "oldest_open": oldest,
                "latest_close": close,
                "pct_change": stable_round((close - oldest) / oldest * 100, 3),
                "window_start_ts": first * cfg.candle_ms,
                "window_end_ts": (newest + 1) * cfg.candle_ms,
                "trade_ts": at,
                "detected_at": iso(at),
            }
        ]

    def close(self) -> None:
        pass


#: Trades of one tick, or of a whole session, folded: first and last price, count, volume, and when they came.
FOLD = "open double, last double, n bigint, volume double, first_t bigint, first_seq bigint, last_t bigint, last_seq bigint"


def fold_of(t: np.ndarray, p: np.ndarray, v: np.ndarray, seq: np.ndarray) -> tuple:
    """The fold of trades in order."""
    ends = (int(t[0]), int(seq[0]), int(t[-1]), int(seq[-1]))
    return (float(p[0]), float(p[-1]), len(t), float(v.sum()), *ends)


def merged(a: tuple, b: tuple) -> tuple:
    """The fold of both, whichever came first."""
    first, last = min((x[4:6], x[0]) for x in (a, b)), max((x[6:8], x[1]) for x in (a, b))
    return (first[1], last[1], a[2] + b[2], a[3] + b[3], *first[0], *last[0])


def snapshot_row(symbol: str, at: int, fold: tuple | None, cfg: Settings) -> dict:
    """A symbol's entry of a snapshot; without trades its prices are null and it isn't stale."""
    open_, last, n, volume, last_t = (*fold[:4], fold[6]) if fold else (None, None, 0, 0.0, None)
    change = stable_round((last - open_) / open_ * 100, 3) if open_ else None
    return {
        "snapshot_ms": at, "symbol": symbol, "last_price": last, "open_price": open_, "pct_change": change, "trade_count": n,
        "total_volume": volume, "last_trade_ts": last_t, "is_stale": last_t is not None and at - last_t > cfg.stale_ms,
    }


def as_frame(rows: list[dict]) -> pd.DataFrame:
    """As objects, so that absent numbers stay null."""
    return pd.DataFrame({c: pd.Series([r[c] for r in rows], dtype=object) for c in rows[0]})


class SnapshotProcessor(StatefulProcessor):
    """Session state of one symbol at every tick.

    Trades are folded per tick and a tick is emitted by a timer once the watermark has passed it. The watermark
    is the same for all symbols, so a tick appears in one batch for all of them, silent ones included.

    A row without a price is a heartbeat: the symbol is reported from its tick on, trade or no trade. With ``gap_ms`` a symbol's
    session ends after a silence longer than that; until its next trade it is reported like one without trades.
    """

    def __init__(self, cfg: Settings, gap_ms: int | None = None, start_ms: int | None = None):
        if gap_ms is not None and gap_ms < cfg.snapshot_ms:
            raise ValueError("a silence that ends a session must be as long as a tick at least")
        self.cfg, self.gap_ms, self.start_ms = cfg, gap_ms, start_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "tick bigint")
        self.session = handle.getValueState("session", FOLD)
        self.pending = handle.getMapState("pending", "tick bigint", FOLD)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Trades from before ``start_ms``: those of ticks before it are the session so far, and the first tick from it on is due."""
        self._add(iter([initialState]))
        first = -(-self.start_ms // self.cfg.snapshot_ms)
        session = self.session.get() if self.session.exists() else None
        for tick in sorted(k[0] for k in self.pending.keys()):
            if tick < first:
                session = self._after(session, tick)
        if session:
            self.session.update(session)
        self._expect(first)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = self._add(rows)
        if not self.due.exists() or first < self.due.get()[0]:  # an earlier trade came late, before anything was reported
            self._expect(first)
        return iter(())

    def _add(self, rows: Iterator[pd.DataFrame]) -> int:
        """Fold trades into their ticks; returns the first tick of any row."""
        step = self.cfg.snapshot_ms
        new = pd.concat(list(rows), ignore_index=True)
        trades = new[new["p"].notna()]
        if len(trades):
            t, p, v, seq = in_order(iter([trades]))
            ticks, starts = np.unique(-(-t // step), return_index=True)
            for tick, a, b in zip(ticks.tolist(), starts, [*starts[1:], len(t)]):
                fold = fold_of(t[a:b], p[a:b], v[a:b], seq[a:b])
                if self.pending.containsKey((tick,)):
                    fold = merged(tuple(self.pending.getValue((tick,))), fold)
                self.pending.updateValue((tick,), fold)
        return -(-int(new["t"].min()) // step)

    def _expect(self, tick: int) -> None:
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0] * self.cfg.snapshot_ms)
        self.due.update((tick,))
        self.handle.registerTimer(tick * self.cfg.snapshot_ms)

    def _after(self, session: tuple | None, tick: int) -> tuple | None:
        """The session after a tick: its trades are taken from what is pending."""
        gap = float("inf") if self.gap_ms is None else self.gap_ms
        if not self.pending.containsKey((tick,)):
            return session if session and tick * self.cfg.snapshot_ms - session[6] <= gap else None
        fold = tuple(self.pending.getValue((tick,)))
        self.pending.removeKey((tick,))
        return merged(session, fold) if session and fold[4] - session[6] <= gap else fold

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        step, out = self.cfg.snapshot_ms, []
        session = tuple(self.session.get()) if self.session.exists() else None
        tick = self.due.get()[0]
        while tick * step < timerValues.getCurrentWatermarkInMs():
            session = self._after(session, tick)
            out.append(snapshot_row(key[0], tick * step, session, self.cfg))
            tick += 1
        if session:
            self.session.update(session)
        else:
            self.session.clear()
        self.due.update((tick,))
        self.handle.registerTimer(tick * step)
        if out:
            yield as_frame(out)

    def close(self) -> None:
        pass


class TimedSnapshotProcessor(StatefulProcessor):
    """Session state of one symbol at every interval of the clock, also while no trade comes in.

    The first and last price are those of the least and the greatest arrival number, and a snapshot is stamped with the time at
    which it was due. A row without a price is a heartbeat, from which on the symbol is reported.
    """

    def __init__(self, cfg: Settings):
        self.cfg = cfg

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.session = handle.getValueState("session", FOLD)
        self.started = handle.getValueState("started", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        step, now = self.cfg.snapshot_ms, timerValues.getCurrentProcessingTimeInMs()
        if not self.started.exists():
            self.started.update((now,))
            self.handle.registerTimer((now // step + 1) * step)
        session = tuple(self.session.get()) if self.session.exists() else None
        for chunk in rows:
            new = chunk[chunk["p"].notna()].sort_values("seq", kind="stable")
            if len(new):
                t, p, v, seq = (new[c].to_numpy(dtype=d) for c, d in (("t", np.int64), ("p", float), ("v", float), ("seq", np.int64)))
                # by arrival alone, so the number stands in for the time; the time kept is the latest
                fold = fold_of(seq, p, v, seq)
                latest = max(int(t.max()), session[6] if session else 0)
                before = session and (*session[:4], session[5], session[5], session[7], session[7])
                both = merged(before, fold) if before else fold
                session = (*both[:6], latest, both[7])
        if session:
            self.session.update(session)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        step, at = self.cfg.snapshot_ms, expiredTimerInfo.getExpiryTimeInMs()
        now = timerValues.getCurrentProcessingTimeInMs()
        session = tuple(self.session.get()) if self.session.exists() else None
        self.handle.registerTimer(max(at, now // step * step) + step)
        yield as_frame([snapshot_row(key[0], at, session, self.cfg)])

    def close(self) -> None:
        pass
