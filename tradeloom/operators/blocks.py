"""Running values over a whole key, computed block by block so that no task holds a whole key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(
    rows: DataFrame,
    keys: Sequence[str],
    block: str,
    order: Sequence[str],
    values: Mapping[str, tuple[str, str]],
    include_current: bool = True,
    place: Column | None = None,
) -> DataFrame:
    """Add running aggregates in ``order`` over each key.

    ``values`` maps an output name to ``(kind, column)``, kind one of ``count sum min max first last``
    (nulls ignored). ``block`` must grow with ``order``: every row of a block comes before every row of
    the next. Blocks are pre-aggregated to one row each, those few rows are accumulated per key, and each
    block then continues from the value it inherits. ``place`` may give the order inside a block as one
    number, which ``first`` and ``last`` aggregate faster by.
    """
    place = F.struct(*order) if place is None else place
    totals, inherit, local, merged = [], [], [], []
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, block).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow if include_current else -1)
    for name, (kind, column) in values.items():
        c, total, kept, here = F.col(column), f"_t_{name}", F.col(f"_c_{name}"), F.col(f"_l_{name}")
        if kind in ("count", "sum"):
            agg = F.count if kind == "count" else F.sum
            totals.append(agg(c).alias(total))
            inherit.append(F.sum(total).over(before))
            local.append(agg(c).over(inside))
            merged.append(F.coalesce(kept, F.lit(0)) + F.coalesce(here, F.lit(0)))
        elif kind in ("min", "max"):
            agg, pick = (F.min, F.least) if kind == "min" else (F.max, F.greatest)
            totals.append(agg(c).alias(total))
            inherit.append(agg(total).over(before))
            local.append(agg(c).over(inside))
            merged.append(pick(kept, here))
        elif kind in ("first", "last"):
            by, agg = (F.min_by, F.first) if kind == "first" else (F.max_by, F.last)
            totals.append(by(c, F.when(c.isNotNull(), place)).alias(total))
            inherit.append(agg(total, ignorenulls=True).over(before))
            local.append(agg(c, ignorenulls=True).over(inside))
            merged.append(F.coalesce(kept, here) if kind == "first" else F.coalesce(here, kept))
        else:
            raise ValueError(f"unknown kind {kind}")
    names = list(values)
    carried = (
        rows.groupBy(*keys, block)
        .agg(*totals)
        .select(*keys, block, *[c.alias(f"_c_{n}") for n, c in zip(names, inherit)])
    )
    stepped = rows.select("*", *[c.alias(f"_l_{n}") for n, c in zip(names, local)])
    return stepped.join(carried, [*keys, block]).select(
        *[F.col(c) for c in rows.columns], *[c.alias(n) for n, c in zip(names, merged)]
    )


def numbered(rows: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], name: str = "rn") -> DataFrame:
    """Add the 1-based position of each row within its key."""
    return running(rows.withColumn("_one", F.lit(1)), keys, block, order, {name: ("count", "_one")}).drop("_one")


def with_preceding(rows: DataFrame, number: str, preceding: int, size: int = 4096) -> DataFrame:
    """Split numbered rows into runs of ``size`` (``_run``), each led by the ``preceding`` rows before it.

    A frame of that many preceding rows, taken per ``(key, _run)``, then sees the same rows as one taken
    over the whole key. Leading copies have ``_copy`` set; drop them after the window.
    """
    run = F.col(number) - F.pmod(F.col(number), F.lit(size))
    late = F.pmod(F.col(number), F.lit(size)) >= size - preceding
    targets = F.when(late, F.array(run, run + size)).otherwise(F.array(run))
    return rows.withColumn("_run", F.explode(targets)).withColumn("_copy", F.col("_run") > F.col(number))


def next_value(rows: DataFrame, keys: Sequence[str], block: str, order: str, column: Column, name: str) -> DataFrame:
    """Add ``column`` of the following row of the key, also where that row lies in a later block."""
    inside = Window.partitionBy(*keys, block).orderBy(order)
    heads = rows.groupBy(*keys, block).agg(F.min_by(column, order).alias("_head"))
    following = heads.select(
        *keys, block, F.lead("_head").over(Window.partitionBy(*keys).orderBy(block)).alias("_next_head")
    )
    stepped = rows.withColumn("_next", F.lead(column).over(inside))
    return (
        stepped.join(following, [*keys, block])
        .withColumn(name, F.coalesce("_next", "_next_head"))
        .drop("_next", "_next_head")
    )
