"""Greedy cooldown: keep a candidate only when the last kept one is at least the cooldown away."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import bucket
from tradeloom.storage import shared_root

_NEVER = -(2**62)


# Blocks that are put together at a time, and the blocks of a key that are walked in one go at the top.
FAN, AT_TOP = 64, 4096


def cooldown_thin(
    candidates: DataFrame,
    keys: Sequence[str],
    t: str,
    tie: str,
    cooldown_ms: int,
    cooldowns_per_block: int = 16,
    fan: int = FAN,
    at_top: int = AT_TOP,
) -> DataFrame:
    """Thin candidates per key in ``(t, tie)`` order. The first one always passes; a gap of exactly the
    cooldown passes too. ``tie`` is unique among the candidates of a key with an equal ``t``.

    The rule is sequential, but a block of time only depends on the past through one number: the earliest
    time at which it may fire. Each block therefore works out, independently, when it would next be free
    for every candidate it could start from, reduced to the points where the answer changes: a step function.
    The step functions of ``fan`` consecutive blocks make one of the same kind, and so on upwards until a key has few
    blocks left. Those are walked, and then the starting times are handed down level by level, in parallel. No task sees
    more than ``fan`` blocks, or ``at_top`` at the top, however long a key's history is and whether it has gaps or not.

    Of candidates with an equal time only the first can pass, so times are made distinct before they are
    gathered: a block has at most one row per millisecond, whatever the data. Only times and ties go through
    Python; the candidates themselves are matched to the kept ones at the end.
    """
    block_ms = cooldown_ms * cooldowns_per_block
    times = (
        candidates.groupBy(*keys, F.col(t).alias("_t"))
        .agg(F.min(tie).alias("_tie"))
        .withColumn("_block", bucket("_t", block_ms))
    )
    by_block = [*keys, "_block"]
    types = {f.name: f.dataType.simpleString() for f in times.schema}
    block_schema = ", ".join(f"{c} {types[c]}" for c in by_block)
    step_schema = f"{block_schema}, _start bigint, _free bigint"

    def outcomes(group: pd.DataFrame) -> pd.DataFrame:
        starts, free_at = block_outcomes(np.sort(group["_t"].to_numpy()), cooldown_ms, block_ms)
        out = group[by_block].iloc[[0] * len(starts)].reset_index(drop=True)
        return out.assign(_start=starts, _free=free_at)

    spark = candidates.sparkSession
    folder = f"{shared_root(spark)}/cooldown-{uuid.uuid4().hex}"

    def written(rows: DataFrame, level: int) -> DataFrame:
        rows.write.parquet(f"{folder}/{level}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{level}")

    def together(width: int):
        def run(group: pd.DataFrame) -> pd.DataFrame:
            parent = int(group["_parent"].iloc[0])
            starts, free_at = composed(_by_block(group), parent * width + cooldown_ms)
            out = group[by_block].iloc[[0] * len(starts)].reset_index(drop=True)
            return out.assign(_block=parent, _start=starts, _free=free_at)

        return run

    levels = [written(times.groupBy(*by_block).applyInPandas(outcomes, step_schema), 0)]
    while True:
        blocks = levels[-1].select(*by_block).distinct().groupBy(*keys).count().agg(F.max("count")).first()[0]
        if (blocks or 0) <= at_top:
            break
        level = len(levels)
        children = levels[-1].withColumn("_parent", F.expr(f"_block div {fan}L")).groupBy(*keys, "_parent")
        levels.append(written(children.applyInPandas(together(block_ms * fan**level), step_schema), level))

    entry_schema = f"{block_schema}, _may_fire bigint"

    def enter(group: pd.DataFrame, may_fire: int) -> pd.DataFrame:
        rows = []
        for block, starts, free_at in _by_block(group):
            rows.append((block, may_fire))
            at = int(np.searchsorted(starts, may_fire, side="left"))
            may_fire = int(free_at[at]) if at < len(starts) else may_fire
        out = group[by_block].iloc[[0] * len(rows)].reset_index(drop=True)
        return out.assign(_block=[b for b, _ in rows], _may_fire=[m for _, m in rows])

    entries = levels[-1].groupBy(*keys).applyInPandas(lambda group: enter(group, _NEVER), entry_schema)
    for level in reversed(levels[:-1]):
        known = entries.withColumnRenamed("_block", "_parent")
        inside = level.withColumn("_parent", F.expr(f"_block div {fan}L")).join(known, [*keys, "_parent"])
        entries = inside.groupBy(*keys, "_parent").applyInPandas(
            lambda group: enter(group, int(group["_may_fire"].iloc[0])), entry_schema
        )

    kept_columns = [*keys, "_t", "_tie"]

    def keep(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_t")
        at = kept_positions(group["_t"].to_numpy(), cooldown_ms, group["_may_fire"].iloc[0])
        return group.iloc[at][kept_columns]

    kept = (
        times.join(entries, by_block)
        .groupBy(*by_block)
        .applyInPandas(keep, ", ".join(f"{c} {types[c]}" for c in kept_columns))
        .withColumnsRenamed({"_t": t, "_tie": tie})
    )
    return candidates.join(kept, [*keys, t, tie], "left_semi")


def _by_block(group: pd.DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks in order, each with its step function: starts, and when it is free after each."""
    group = group.sort_values(["_block", "_start"])
    blocks, first = np.unique(group["_block"].to_numpy(), return_index=True)
    cuts = zip(blocks, np.split(group["_start"].to_numpy(), first[1:]), np.split(group["_free"].to_numpy(), first[1:]), strict=True)
    return [(int(b), starts, free_at) for b, starts, free_at in cuts]


def composed(blocks: list[tuple[int, np.ndarray, np.ndarray]], edge: int) -> tuple[np.ndarray, np.ndarray]:
    """The step function of consecutive blocks. What may fire at first lies before ``edge``, one cooldown after the
    blocks begin, or is the first candidate from there on."""
    starts, free_at = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for _, own_starts, own_free in blocks:
        at = np.searchsorted(own_starts, free_at, side="left")
        free_at = np.where(at < len(own_starts), own_free[np.minimum(at, len(own_starts) - 1)], free_at)
        if not len(starts) or starts[-1] < edge:  # a start may lie in this block too
            starts, free_at = np.concatenate([starts, own_starts]), np.concatenate([free_at, own_free])
    ends = np.append(free_at[1:] != free_at[:-1], True)
    return starts[ends], free_at[ends]


def block_outcomes(times: np.ndarray, cooldown_ms: int, block_ms: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted candidate times of one block: the first candidates it could start from, and for each
    the time at which the next block may fire. Neighbours with the same outcome are merged."""
    n = len(times)
    following = np.searchsorted(times, times + cooldown_ms, side="left")
    # A start can lie in the first cooldown of the block, or be the first candidate after it.
    edge = times[0] // block_ms * block_ms + cooldown_ms
    count = min(int(np.searchsorted(times, edge, side="left")) + 1, n)
    last = np.arange(count)
    while True:
        step = following[last]
        moving = step < n
        if not moving.any():
            break
        last = np.where(moving, step, last)
    free_at = times[last] + cooldown_ms
    ends = np.append(free_at[1:] != free_at[:-1], True)
    return times[:count][ends], free_at[ends]


def kept_positions(times: np.ndarray, cooldown_ms: int, may_fire: int) -> list[int]:
    """Positions of the kept candidates among the sorted times of one block."""
    kept, i = [], int(np.searchsorted(times, may_fire, side="left"))
    while i < len(times):
        kept.append(i)
        i = int(np.searchsorted(times, times[i] + cooldown_ms, side="left"))
    return kept
