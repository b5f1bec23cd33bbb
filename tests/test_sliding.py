import random

import pytest
from pyspark.sql import functions as F

from tradeloom.operators.blocks import next_value, numbered, running, with_preceding
from tradeloom.operators.sliding import sliding_stats


def made(spark, n=600, keys=3, span=4000, seed=1):
    rng = random.Random(seed)
    # Few distinct times, so many are equal; one key holds most rows.
    return [(rng.choice("aaaab"[: keys + 2]), rng.randrange(span), i, float(rng.randrange(1, 50))) for i in range(n)]


@pytest.mark.parametrize("parts, hot_rows, span", [(1, None, 4000), (2, None, 4000), (10, None, 4000), (10, 7, 4000), (1, 20, 900), (2, 9, 40)])
def test_equals_brute_force(spark, parts, hot_rows, span):
    rows = made(spark, span=span)
    df = spark.createDataFrame(rows, "k string, t bigint, seq bigint, x double").repartition(5)
    out = sliding_stats(
        df, ["k"], "t", "seq", 300, parts,
        {"n": ("sum", F.lit(1).cast("bigint")), "total": ("sum", F.col("x")), "low": ("min", F.col("x")),
         "high": ("max", F.col("x")), "since": ("min", F.col("t"))},
        {"m": "x"}, hot_rows,
    ).collect()
    assert len(out) == len(rows)
    for r in out:
        window = [x for k, t, s, x in rows if k == r.k and r.t - 300 <= t and (t, s) <= (r.t, r.seq)]
        since = min(t for k, t, s, x in rows if k == r.k and r.t - 300 <= t and (t, s) <= (r.t, r.seq))
        mean = sum(window) / len(window)
        assert (r.n, r.total, r.low, r.high, r.since) == (len(window), sum(window), min(window), max(window), since)
        assert r.m_mean == pytest.approx(mean)
        assert r.m_var == pytest.approx(sum((x - mean) ** 2 for x in window) / len(window), abs=1e-9)


def test_equal_values_have_no_variance(spark):
    rows = [("a", t * 7, t, 182.1) for t in range(500)]
    df = spark.createDataFrame(rows, "k string, t bigint, seq bigint, x double")
    out = sliding_stats(df, ["k"], "t", "seq", 100, 10, {"n": ("sum", F.lit(1))}, {"m": "x"})
    assert out.filter("m_var <> 0 or m_mean <> 182.1").count() == 0


def test_width_must_divide(spark):
    df = spark.createDataFrame([("a", 1, 1, 1.0)], "k string, t bigint, seq bigint, x double")
    with pytest.raises(ValueError):
        sliding_stats(df, ["k"], "t", "seq", 100, 3, {})


def test_one_shuffle_of_the_rows(spark):
    df = spark.range(100).selectExpr("string(id % 3) as k", "id as t", "id as seq", "double(id) as x")
    out = sliding_stats(df, ["k"], "t", "seq", 30, 1, {"n": ("sum", F.lit(1))})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_running_over_blocks(spark):
    rows = [(k, t, i, x if i % 4 else None) for i, (k, t, _, x) in enumerate(made(spark, 300))]
    df = spark.createDataFrame(rows, "k string, t bigint, seq bigint, x double").withColumn("b", F.expr("t div 100"))
    kinds = {f"{k}_x": (k, "x") for k in ("count", "sum", "min", "max", "first", "last")}
    got = running(df, ["k"], "b", ["t", "seq"], kinds).collect()
    before = {(r.k, r.seq): r for r in running(df, ["k"], "b", ["t", "seq"], kinds, include_current=False).collect()}
    for r in got:
        for edge, row in ((lambda a, b: a <= b, r), (lambda a, b: a < b, before[r.k, r.seq])):
            xs = [x for k, t, s, x in sorted(rows, key=lambda z: (z[1], z[2])) if k == r.k and edge((t, s), (r.t, r.seq)) and x is not None]
            want = (len(xs), sum(xs), *((min(xs), max(xs), xs[0], xs[-1]) if xs else (None,) * 4))
            assert tuple(row[f"{k}_x"] for k in ("count", "sum", "min", "max", "first", "last")) == want


def test_numbers_and_preceding_rows(spark):
    rows = made(spark, 400)
    df = spark.createDataFrame(rows, "k string, t bigint, seq bigint, x double").withColumn("b", F.expr("t div 500"))
    ranked = numbered(df, ["k"], "b", ["t", "seq"])
    for key in {r[0] for r in rows}:
        numbers = [r.rn for r in ranked.filter(F.col("k") == key).orderBy("t", "seq").collect()]
        assert numbers == list(range(1, len(numbers) + 1))
    from pyspark.sql import Window

    frame = Window.partitionBy("k", "_run").orderBy("rn").rowsBetween(-4, 0)
    whole = Window.partitionBy("k").orderBy("rn").rowsBetween(-4, 0)
    split = with_preceding(ranked, "rn", 4, size=16).withColumn("y", F.sum("x").over(frame)).filter("not _copy")
    a = sorted((r.k, r.rn, r.y) for r in split.collect())
    b = sorted((r.k, r.rn, r.y) for r in ranked.withColumn("y", F.sum("x").over(whole)).collect())
    assert a == b


def test_next_value_crosses_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 950), ("b", 5)], "k string, t bigint")
    out = next_value(df.withColumn("b", F.expr("t div 100")), ["k"], "b", "t", F.col("t"), "nxt")
    assert sorted((r.k, r.t, r.nxt) for r in out.collect()) == [("a", 1, 2), ("a", 2, 950), ("a", 950, None), ("b", 5, None)]


def test_one_time_holds_a_third_of_all_rows(spark):
    rows = made(spark, 400) + [("a", 2000, 1000 + i, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t bigint, seq bigint, x double").repartition(5)
    measures = {"n": ("sum", F.lit(1).cast("bigint")), "total": ("sum", F.col("x")), "high": ("max", F.col("x"))}
    plain = sliding_stats(df, ["k"], "t", "seq", 300, 10, measures, {"m": "x"})
    split = sliding_stats(df, ["k"], "t", "seq", 300, 10, measures, {"m": "x"}, hot_rows=50)
    columns = ["k", "seq", "n", "total", "high", F.round("m_mean", 6), F.round("m_var", 6)]
    assert sorted(map(tuple, plain.select(*columns).collect())) == sorted(map(tuple, split.select(*columns).collect()))


def test_blocks_split_where_hot(spark):
    from tradeloom.operators.skew import time_blocks

    rows = made(spark, 300) + [("a", 2000, 1000 + i, 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t bigint, seq bigint, x double")
    assert time_blocks(df, ["k"], "t", "seq", 100).groupBy("_block").count().agg(F.max("count")).first()[0] >= 200
    blocked = time_blocks(df, ["k"], "t", "seq", 100, hot_rows=40)
    assert blocked.groupBy("k", "_block").count().agg(F.max("count")).first()[0] <= 40
    ranked = numbered(blocked, ["k"], "_block", ["t", "seq"])
    for key in {r[0] for r in rows}:
        numbers = [r.rn for r in ranked.filter(F.col("k") == key).orderBy("t", "seq").collect()]
        assert numbers == list(range(1, len(numbers) + 1))
