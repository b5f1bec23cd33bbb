"""Joins on a key plus a time band, planned as plain equi-joins on (key, time bucket)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import bucket


def band_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: str, right_t: str, low: int, high: int
) -> DataFrame:
    """Inner join where ``right_t - left_t`` lies in ``[low, high]`` (whole numbers, same unit).

    Each left row goes to the two or three buckets its band touches; each right row lies in exactly one,
    so a pair meets once and the time bucket splits a hot key.
    """
    width = high - low + 1
    near = left.withColumn(
        "_bucket",
        F.explode(
            F.sequence(
                F.floor((F.col(left_t) + low) / width).cast("bigint"),
                F.floor((F.col(left_t) + high) / width).cast("bigint"),
            )
        ),
    )
    far = right.withColumn("_bucket", bucket(right_t, width))
    gap = far[right_t] - near[left_t]
    on = [near[k] == far[k] for k in [*keys, "_bucket"]]
    joined = near.join(far, [*on, gap.between(low, high)])
    return joined.select(*[near[c] for c in left.columns], *[far[c] for c in right.columns if c not in keys])
