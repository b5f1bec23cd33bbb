"""Row-at-a-time detectors written from the rules, to compare the Spark operators with."""

import math
from collections import defaultdict
from decimal import ROUND_HALF_EVEN, Decimal


def half_even(x, digits):
    return float(Decimal(repr(round(x, 9))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_EVEN))


def greedy(times, cooldown):
    kept, last = [], None
    for i, t in enumerate(times):
        if last is None or t - last >= cooldown:
            kept.append(i)
            last = t
    return kept


def simulate(rows, cfg, keep_candidates=False):
    """``rows`` are ``(s, p, v, t, seq)``; returns (volume, volatility, momentum) signal lists."""
    seen = defaultdict(list)
    volume, volatility, momentum = [], [], []
    bars, current = defaultdict(list), {}
    last = defaultdict(lambda: None)

    def may_fire(key, t, cooldown):
        if keep_candidates:
            return True
        if last[key] is not None and t - last[key] < cooldown:
            return False
        last[key] = t
        return True

    for s, p, v, t, seq in sorted(rows, key=lambda r: (r[3], r[4])):
        seen[s].append((t, p, v))
        window = [x for x in seen[s] if x[0] >= t - cfg.volume_window_ms]
        if len(window) >= 2 and t - window[0][0] >= cfg.volume_min_span_ms:
            mean = sum(x[2] for x in window[:-1]) / (len(window) - 1)
            if mean > 0 and v >= mean * cfg.volume_multiplier * (1 - 1e-11) and may_fire(("v", s), t, cfg.volume_cooldown_ms):
                volume.append((s, t, seq, half_even(mean, 2), half_even(v / mean, 2), len(window)))
        window = [x for x in seen[s] if x[0] >= t - cfg.volatility_window_ms]
        if len(window) >= 2 and t - window[0][0] >= cfg.volatility_min_span_ms:
            prices = [x[1] for x in window]
            if min(prices) < max(prices):
                mean = sum(prices) / len(prices)
                std = math.sqrt(sum((x - mean) ** 2 for x in prices) / len(prices))
                z = abs(p - mean) / std
                if z >= cfg.volatility_z * (1 - 1e-9) and may_fire(("z", s), t, cfg.volatility_cooldown_ms):
                    volatility.append((s, t, seq, half_even(std, 4), half_even(z, 3), len(window)))
        minute = t // cfg.candle_ms
        if s not in current:
            current[s] = [minute, p, p]
        elif current[s][0] == minute:
            current[s][2] = p
        else:
            bars[s].append(tuple(current[s]))
            current[s] = [minute, p, p]
            done = bars[s][-cfg.momentum_candles :]
            if len(done) == cfg.momentum_candles:
                up = sum(c >= o for _, o, c in done)
                down = len(done) - up
                direction = "UP" if up >= cfg.momentum_min_agree else "DOWN" if down >= cfg.momentum_min_agree else None
                if direction and may_fire(("m", s), t, cfg.momentum_cooldown_ms):
                    pct = half_even((done[-1][2] - done[0][1]) / done[0][1] * 100, 3)
                    momentum.append((s, t, seq, direction, up if direction == "UP" else down, pct))
    return volume, volatility, momentum
