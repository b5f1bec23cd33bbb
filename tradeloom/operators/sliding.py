"""Exact sliding-window aggregates that scale with the number of rows, not rows times window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import bucket
from tradeloom.operators.skew import hot_groups

_AGGREGATE = {"sum": F.sum, "min": F.min, "max": F.max}


def sliding_stats(
    rows: DataFrame,
    keys: Sequence[str],
    pos: str,
    tie: str,
    width: int,
    parts: int,
    measures: Mapping[str, tuple[str, Column]],
    moments: Mapping[str, str] | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Aggregate, for every row, the earlier rows of its key with ``pos`` in ``[pos - width, pos]``.

    Rows with an equal ``pos`` count when their ``tie`` is not larger, so a row sees what arrived before
    it. ``measures`` maps an output name to ``(sum | min | max, value)``; ``moments`` maps an output
    prefix to a column without nulls and adds ``<prefix>_mean`` and ``<prefix>_var`` (population).

    The axis is cut into slices of ``width / parts``. A window that ends in slice ``c`` covers the head of
    ``c``, all of ``c-parts+1 .. c-1`` and the tail of ``c-parts``. Each row is therefore sent to its own
    slice (it *enters*) and ``parts`` slices on (it *leaves*), and the whole slices between arrive as one
    pre-aggregated row each. One pass forward adds what entered, one pass backward what has not yet left.
    Values are only ever added, never subtracted, so sums carry no cancellation error. A task holds two
    slices of one key however large the key is, and one shuffle moves everything.

    With ``hot_rows`` given, slices with more rows than that are looked for first, and those found are split
    into pieces of one ``pos`` and at most ``hot_rows`` consecutive ``tie`` numbers. Pieces are worked on
    separately and then offset by the totals of the pieces before and after them.
    """
    if width % parts:
        raise ValueError("width must be a multiple of parts")
    moments = dict(moments or {})
    step = width // parts
    slice_of = bucket(pos, step)
    at = F.when(F.col("_kind") == 2, F.col(pos) + width).otherwise(F.col(pos))

    events = rows.withColumn("_kind", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "_slice", slice_of + (F.col("_kind") - 1) * parts
    )
    if parts > 1:
        events = events.unionByName(_whole_slices(rows, keys, pos, slice_of, step, parts, measures, moments), True)
    group, hot = [*keys, "_slice"], None
    if hot_rows is not None:
        means = [F.avg(F.col(c).cast("double")).alias(f"_near_{n}") for n, c in moments.items()]
        hot = hot_groups(rows, [*keys, slice_of.alias("_slice")], hot_rows, *means)
    if hot is not None:
        touched = (
            hot.withColumn("_slice", F.explode(F.array(F.col("_slice"), F.col("_slice") + parts)))
            .groupBy(*group)
            .agg(F.lit(True).alias("_hot"), *[F.max(f"_near_{n}").alias(f"_near_{n}") for n in moments])
        )
        piece = F.struct(at.alias("at"), F.col("_kind").alias("kind"), bucket(tie, hot_rows).alias("tie"))
        events = events.join(touched, group, "left").withColumn("_piece", F.when(F.col("_hot"), piece))
        group = [*group, "_piece"]
    # Only the row itself is shuffled; what follows from it is worked out on the other side.
    apart = events
    events = events.repartition(*group).withColumn("_at", at)

    def part(name: str, value: Column) -> Column:
        return F.when(F.col("_kind") == 0, F.col(f"_whole.{name}")).otherwise(value) if parts > 1 else value

    together = Window.partitionBy(*group)
    forward = together.orderBy("_at", "_kind", tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backward = together.orderBy(F.desc("_at"), F.desc("_kind"), F.desc(tie)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    entered, staying = F.col("_kind") < 2, F.col("_kind") == 2

    sums: dict[str, tuple[str, Column]] = {n: (kind, part(n, value)) for n, (kind, value) in measures.items()}
    count = part("_rows", F.lit(1).cast("bigint"))
    if moments:
        sums["_rows"] = ("sum", count)
    for name, column in moments.items():
        # Deviations are taken from a value of the same slice, which keeps the squares small.
        mean = part(f"{name}_mean", F.col(column).cast("double"))
        near = F.first(mean).over(forward)
        events = events.withColumn(f"_ref_{name}", near if hot is None else F.coalesce(f"_near_{name}", near))
        off = mean - F.col(f"_ref_{name}")
        sums[f"_d1_{name}"] = ("sum", count * off)
        sums[f"_d2_{name}"] = ("sum", part(f"{name}_m2", F.lit(0.0)) + count * off * off)

    out = events.select(
        "*", *[_over_part(k, c, entered).over(forward).alias(f"_f{n}") for n, (k, c) in sums.items()]
    ).select("*", *[_over_part(k, c, staying).over(backward).alias(f"_b{n}") for n, (k, c) in sums.items()])
    if hot is None:
        both = {n: _merge(kind, F.col(f"_f{n}"), F.col(f"_b{n}")) for n, (kind, _) in sums.items()}
    else:
        apart = apart.filter("_hot").withColumns({f"_ref_{n}": F.col(f"_near_{n}") for n in moments})
        out = out.join(_other_pieces(apart, group, sums, entered, staying), group, "left")
        merged = {}
        for n, (kind, _) in sums.items():
            others = [F.col(f"_before_{n}"), F.col(f"_after_{n}")]
            if kind == "sum":
                others = [F.coalesce(c, F.lit(0)) for c in others]
            merged[n] = _merge(kind, F.col(f"_f{n}"), F.col(f"_b{n}"), *others)
        # As a generator, this is not copied into every expression that follows.
        out = out.select("*", F.inline(F.array(F.struct(*[c.alias(f"_all_{n}") for n, c in merged.items()]))))
        both = {n: F.col(f"_all_{n}") for n in sums}

    result = [both[n].alias(n) for n in measures]
    for name in moments:
        mean_off = both[f"_d1_{name}"] / both["_rows"]
        spread = both[f"_d2_{name}"] / both["_rows"] - mean_off * mean_off
        result.append((F.col(f"_ref_{name}") + mean_off).alias(f"{name}_mean"))
        result.append(F.greatest(spread, F.lit(0.0)).alias(f"{name}_var"))
    return out.filter(F.col("_kind") == 1).select(*rows.columns, *result)


def _over_part(kind: str, value: Column, included: Column) -> Column:
    """Aggregate the included rows; a sum over none of them is 0, so that sums can simply be added.

    What follows stays one short expression. Long ones make generated methods that the JVM will not compile.
    """
    picked = F.when(included, value)
    return F.sum(picked.otherwise(F.lit(0))) if kind == "sum" else _AGGREGATE[kind](picked)


def _merge(kind: str, *values: Column) -> Column:
    """Combine partial aggregates; least and greatest pass over nulls."""
    if kind == "min":
        return F.least(*values)
    if kind == "max":
        return F.greatest(*values)
    return reduce(Column.__add__, values)


def _other_pieces(events, group, sums, entered, staying) -> DataFrame:
    """What the pieces of a split slice take over: entered values before them, staying values after them."""
    *slice_, piece = group
    totals = events.groupBy(*group).agg(
        *[_over_part(k, c, entered).alias(f"_t{n}") for n, (k, c) in sums.items()],
        *[_over_part(k, c, staying).alias(f"_u{n}") for n, (k, c) in sums.items()],
    )
    ahead = Window.partitionBy(*slice_).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*slice_).orderBy(F.desc(piece)).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *group,
        *[_AGGREGATE[k](f"_t{n}").over(ahead).alias(f"_before_{n}") for n, (k, _) in sums.items()],
        *[_AGGREGATE[k](f"_u{n}").over(behind).alias(f"_after_{n}") for n, (k, _) in sums.items()],
    )


def _whole_slices(rows, keys, pos, slice_of, step, parts, measures, moments) -> DataFrame:
    """One mergeable row per (key, slice), copied to the ``parts - 1`` slices whose windows cover it whole."""
    columns = [_AGGREGATE[kind](value).alias(n) for n, (kind, value) in measures.items()]
    if moments:
        columns.append(F.count(F.lit(1)).alias("_rows"))
    for name, column in moments.items():
        x = F.col(column).cast("double")
        # The mean of equal values is that value, without a rounding error of sum / count.
        mean = F.when(F.min(x) == F.max(x), F.min(x)).otherwise(F.avg(x))
        columns += [
            mean.alias(f"{name}_mean"),
            (F.var_pop(x) * F.count(x)).alias(f"{name}_m2"),
        ]
    totals = rows.groupBy(*keys, slice_of.alias("_from")).agg(F.struct(*columns).alias("_whole"))
    spread = totals.withColumn("_slice", F.explode(F.sequence(F.col("_from") + 1, F.col("_from") + parts - 1)))
    # Sorts before every row of the target slice, the older slice first.
    before = F.col("_slice") * F.lit(step).cast("bigint") - (F.col("_slice") - F.col("_from"))
    return spread.select(*keys, "_slice", "_whole", F.lit(0).alias("_kind"), before.alias(pos))
