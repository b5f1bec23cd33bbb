"""Positions within groups of any size, found without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import stage

#: Rows of a task are numbered below, tasks above this bit by ``monotonically_increasing_id``.
TASK_BIT = 33


def placed(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place``, the 0-based position within the group, and ``size``, the group's number of rows.

    Rows are dealt out in ranges of (group, order), so a large group lies in several tasks, and are written with their number
    within the task. Counts per task and group then tell where each task's share of a group begins. Nulls come first; rows
    equal in all of ``order`` are interchangeable and lie in any order, also in several tasks. The columns of ``group`` must
    hold no null.
    """
    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    dealt = rows.withColumn("_salt", F.rand(7)).repartitionByRange(*by, F.col("_salt")).sortWithinPartitions(*by)
    laid = stage(dealt.drop("_salt").withColumn("_at", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("_task", F.shiftright("_at", TASK_BIT))
    runs = laid.groupBy(*group, "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *group, "_task", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size")
    )
    return laid.join(runs, [*group, "_task"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_task", "_shift")
