import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from simulate import greedy

from tradeloom.operators.cooldown import block_outcomes, composed, cooldown_thin, kept_positions


@pytest.mark.parametrize("per_block, fan, at_top", [(1, 64, 4096), (32, 64, 4096), (1, 2, 1), (3, 3, 2), (2, 5, 4)])
def test_equals_greedy(spark, per_block, fan, at_top):
    """Also with few blocks to a task, so that the step functions are put together in several levels."""
    rng = random.Random(per_block)
    rows, seq = [], 0
    for key, n, span in (("dense", 900, 3000), ("sparse", 60, 50_000), ("gaps", 200, 1500)):
        for _ in range(n):
            t = rng.randrange(span)
            rows.append((key, t if key != "gaps" else t + t // 300 * 5000, seq, f"x{seq}"))
            seq += 1
    df = spark.createDataFrame(rows, "k string, t bigint, seq bigint, payload string").repartition(3)
    got = sorted(tuple(r) for r in cooldown_thin(df, ["k"], "t", "seq", 180, per_block, fan, at_top).collect())
    want = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        want += [mine[i] for i in greedy([r[1] for r in mine], 180)]
    assert got == sorted(want)


def test_hand_case(spark):
    times = [100_000, 200_000, 279_999, 280_000, 400_000, 460_000]
    df = spark.createDataFrame([("a", t, i) for i, t in enumerate(times)], "k string, t bigint, seq bigint")
    got = [r.t for r in cooldown_thin(df, ["k"], "t", "seq", 180_000).orderBy("t").collect()]
    assert got == [100_000, 280_000, 460_000]


def test_empty(spark):
    df = spark.createDataFrame([], "k string, t bigint, seq bigint")
    assert cooldown_thin(df, ["k"], "t", "seq", 180).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=120), st.integers(1, 200), st.integers(1, 6))
def test_blocks_compose(times, cooldown, per_block):
    """Walking block by block through the reduced outcomes gives the greedy answer."""
    times, width = sorted(times), cooldown * per_block
    blocks, may_fire, kept = {}, -(2**62), []
    for t in times:
        blocks.setdefault(t // width, []).append(t)
    for number in sorted(blocks):
        inside = np.array(blocks[number])
        kept += [int(inside[i]) for i in kept_positions(inside, cooldown, may_fire)]
        starts, free_at = block_outcomes(inside, cooldown, width)
        fitting = np.flatnonzero(starts >= may_fire)
        if len(fitting):
            may_fire = int(free_at[fitting[0]])
    assert kept == [times[i] for i in greedy(times, cooldown)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6000), min_size=1, max_size=150), st.integers(1, 200), st.integers(1, 4), st.integers(2, 5))
def test_step_functions_compose(times, cooldown, per_block, fan):
    """Blocks put together give what walking through them gives, from every time that may come first."""
    times, width = sorted(times), cooldown * per_block
    blocks = {}
    for t in times:
        blocks.setdefault(t // width, []).append(t)
    steps = [(b, *block_outcomes(np.array(blocks[b]), cooldown, width)) for b in sorted(blocks)]
    parents = {}
    for step in steps:
        parents.setdefault(step[0] // fan, []).append(step)
    for parent, own in parents.items():
        begin = parent * fan * width
        starts, free_at = composed(own, begin + cooldown)
        for may_fire in range(begin - 5, begin + cooldown, max(1, cooldown // 7)):
            walked = may_fire
            for _, s, f in own:
                at = int(np.searchsorted(s, walked, side="left"))
                walked = int(f[at]) if at < len(s) else walked
            at = int(np.searchsorted(starts, may_fire, side="left"))
            assert walked == (int(free_at[at]) if at < len(starts) else may_fire)
