"""Exact percentiles without gathering a column in one task."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.storage import shared_root


def exact_percentiles(rows: DataFrame, column: str, wanted: Mapping[str, float], bins: int = 4096) -> DataFrame:
    """One row with the linearly interpolated percentiles (``name -> fraction``) of a column's values; nulls don't count.

    Equal values are counted first, so a value that fills the table costs one row. Then the range of the values is cut
    into bins, and each bin that holds a wanted rank is cut again between its own least and greatest value, until it
    is a single value. A round is one aggregate with at most ``bins`` rows for the driver, whatever is counted and however
    the values crowd together, and no bin is ever sorted.
    """
    spark = rows.sparkSession
    names = list(wanted)
    result = ", ".join(f"`{n}` double" for n in names)
    counts = rows.select(F.col(column).cast("double").alias("x")).filter("x is not null").groupBy("x")
    path = f"{shared_root(spark)}/counts-{uuid.uuid4().hex}"
    counts.agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = spark.read.schema("x double, n bigint").parquet(path)
    whole = counts.agg(F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    if not whole["n"]:
        return spark.createDataFrame([(None,) * len(names)], result)

    place = {n: p * (whole["n"] - 1) for n, p in wanted.items()}
    ranks = {side(at) for at in place.values() for side in (math.floor, math.ceil)}
    found: dict[int, float] = {}
    _locate(counts, F.lit(True), sorted(ranks), 0, whole["low"], whole["high"], bins, found)

    def between(at: float) -> float:
        low, high = found[math.floor(at)], found[math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    return spark.createDataFrame([tuple(between(place[n]) for n in names)], result)


def _locate(
    counts: DataFrame, inside: Column, ranks: list[int], below: int, low: float, high: float, bins: int, found: dict[int, float]
) -> None:
    """Fill ``found`` with the values of the ranks, all of which lie among the rows ``inside``; ``below`` rows are less."""
    if low == high:
        found.update(dict.fromkeys(ranks, low))
        return
    cell = F.least(F.lit(bins - 1), F.floor((F.col("x") - low) / (high - low) * bins))
    cells = counts.filter(inside).groupBy(cell.alias("cell"))
    cells = cells.agg(F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
    for c in sorted(cells, key=lambda c: c["cell"]):
        own = [r for r in ranks if below <= r < below + c["n"]]
        if own:
            _locate(counts, inside & (cell == c["cell"]), own, below, c["low"], c["high"], bins, found)
        below += c["n"]
