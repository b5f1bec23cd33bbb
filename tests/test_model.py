import json
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.operators import evaluation, features, iforest
from tradeloom.schemas import FEATURE_COLS
from tradeloom.sources import medallion


def test_features_of_a_bucket(trades):
    df = trades([("a", 10, 10, 1), ("a", 20, 12, 3), ("b", 299.999, 5, 1), ("b", 300, 6, 1)])
    got = {(r.symbol, r.bucket): r for r in features.feature_windows(df, 300_000).collect()}
    assert sorted(got) == [("a", 0), ("b", 0), ("b", 1)]
    r = got["a", 0]
    assert [r[c] for c in FEATURE_COLS] == [2, 11, 1, 10, 12, 4, 2, 3, pytest.approx(20)]
    assert r.event_time == "1970-01-01T00:00:20Z"
    one = got["b", 0]
    assert (one.price_std, one.price_change_pct, one.event_time) == (0.0, 0.0, "1970-01-01T00:04:59Z")


def test_first_and_last_follow_time(spark):
    df = spark.createDataFrame([("a", 3.0, 1.0, 2000, 0), ("a", 1.0, 1.0, 1000, 1), ("a", 4.0, 1.0, 2000, 2)], "s string, p double, v double, t bigint, seq bigint")
    (r,) = features.feature_windows(df, 300_000).collect()
    assert r.price_change_pct == pytest.approx(300)


@pytest.mark.parametrize("recent", [2, 7, 100])
def test_recent_features(spark, recent):
    rng = random.Random(recent)
    rows, t = [], 0
    for i in range(500):
        t += rng.choice([0, 0, 50, 900, 40_000])
        rows.append((rng.choice("aaab"), float(rng.randrange(1, 90)), float(rng.randrange(9)), t, i))
    df = spark.createDataFrame(rows, "s string, p double, v double, t bigint, seq bigint").repartition(4)
    for r in features.feature_recent(df, recent, 10_000).collect():
        mine = sorted((x for x in rows if x[0] == r.symbol and (x[3], x[4]) <= (r.t, r.seq)), key=lambda x: (x[3], x[4]))[-recent:]
        p, v = [x[1] for x in mine], [x[2] for x in mine]
        want = [len(p), np.mean(p), np.std(p), min(p), max(p), sum(v), np.mean(v), max(v), (p[-1] - p[0]) / p[0] * 100]
        assert [r[c] for c in FEATURE_COLS] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("block_ms", [500, 20_000, 10_000_000])
def test_recent_features_of_some_trades(spark, block_ms):
    rng = random.Random(block_ms)
    rows = [(rng.choice("aaab"), float(rng.randrange(1, 90)), 1.0, rng.randrange(90) * 700, i) for i in range(600)]
    df = spark.createDataFrame(rows, "s string, p double, v double, t bigint, seq bigint").repartition(4)
    some = df.filter("seq % 37 = 0").selectExpr("s as symbol", "t as trade_ts", "seq")
    got = features.feature_recent(df, 20, block_ms, some)
    want = features.feature_recent(df, 20, block_ms).filter("seq % 37 = 0")
    rounded = ["symbol", "seq", *[F.round(c, 6) for c in FEATURE_COLS]]
    assert sorted(map(tuple, got.select(*rounded).collect())) == sorted(map(tuple, want.select(*rounded).collect()))
    kept = features._looked_back_on(df, some.selectExpr("symbol as s", "trade_ts as t", "seq"), 20, 10_000_000)
    assert kept.count() < len(rows)


def test_split_and_csv(spark, tmp_path):
    now = datetime(2024, 1, 10)
    cutoff = int((now - timedelta(days=2) - datetime(1970, 1, 1)).total_seconds() * 1000)
    base = spark.createDataFrame([("a", cutoff - 1), ("a", cutoff)], "symbol string, max_t bigint")
    for c in FEATURE_COLS:
        base = base.withColumn(c, F.lit(1.5))
    out = features.split_by_time(base.withColumn("event_time", F.lit("x")), now, 2)
    assert {r.max_t: r.split for r in out.collect()} == {cutoff - 1: "train", cutoff: "validation"}
    medallion.write_feature_csv(out.select("symbol", "event_time", *FEATURE_COLS, "split"), str(tmp_path / "csv"))
    back = medallion.read_feature_csv(spark, str(tmp_path / "csv"), "train")
    assert [(r.symbol, r.price_mean) for r in back.collect()] == [("a", 1.5)]
    assert (tmp_path / "csv" / "split=validation").is_dir()
    header = next((tmp_path / "csv" / "split=train").glob("*.csv")).read_text().splitlines()[0]
    assert header == ",".join(["symbol", "event_time", *FEATURE_COLS])


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(1500, 9))
    points[:15] += 12
    data = [(f"s{i % 3}", str(i), *map(float, x)) for i, x in enumerate(points)]
    ddl = "symbol string, event_time string, " + ", ".join(f"{c} double" for c in FEATURE_COLS)
    return spark.createDataFrame(data, ddl).repartition(4).persist()


def test_forest_finds_outliers(cloud):
    model = iforest.IsolationForest().fit(cloud)
    scored = model.transform(cloud)
    ends = scored.agg(F.min("score"), F.max("score")).first()
    assert tuple(ends) == (0.0, 1.0)
    top = {int(r.event_time) for r in scored.orderBy(F.desc("score")).limit(15).collect()}
    assert top == set(range(15))
    rate = evaluation.report(scored).first()["anomaly_rate"]
    assert 0 < rate < 0.5
    assert model.nodes["tree"].nunique() == 200
    assert model.nodes["sample_size"].min() == 256
    assert len(model.nodes) <= 200 * 511
    assert model.nodes["depth"].max() <= 8


def test_forest_is_reproducible_and_saved(spark, cloud, tmp_path):
    a = iforest.IsolationForest(numTrees=20).fit(cloud)
    b = iforest.IsolationForest(numTrees=20).fit(cloud.repartition(7))
    assert a.nodes.equals(b.nodes)
    assert (a.low, a.high) == (b.low, b.high)
    assert not a.nodes.equals(iforest.IsolationForest(numTrees=20, seed=1).fit(cloud).nodes)
    a.save(spark, str(tmp_path))
    c = iforest.IsolationForestModel.load(spark, str(tmp_path))
    both = a.transform(cloud).select("event_time", "score").join(c.transform(cloud).selectExpr("event_time", "score as again"), "event_time")
    assert both.filter("score <> again").count() == 0


def test_forest_in_a_saved_pipeline(spark, cloud, tmp_path):
    """Estimator and model are stages of a pipeline like any other: both save and load whole."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import SQLTransformer

    halved = SQLTransformer(statement="SELECT symbol, event_time, " + ", ".join(f"{c} / 2 AS {c}" for c in FEATURE_COLS) + " FROM __THIS__")
    forest = iforest.IsolationForest(key=("event_time",), numTrees=12, seed=5, orientation="raw")
    Pipeline(stages=[halved, forest]).write().overwrite().save(str(tmp_path / "unfitted"))
    unfitted = Pipeline.load(str(tmp_path / "unfitted"))
    assert unfitted.getStages()[1].key == ("event_time",)
    fitted = unfitted.fit(cloud)
    again = Pipeline(stages=[halved, forest]).fit(cloud)
    fitted.save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    own = loaded.stages[1]
    assert isinstance(own, iforest.IsolationForestModel) and own.getOrDefault("seed") == 5 and own.getOrDefault("orientation") == "raw"
    assert own.nodes.equals(again.stages[1].nodes) and (own.low, own.high) == (again.stages[1].low, again.stages[1].high)
    scores = [{r.event_time: r.score for r in m.transform(cloud).collect()} for m in (again, loaded)]
    assert scores[0] == scores[1] and len(set(scores[0].values())) > 100
    with pytest.raises(Exception, match="already exists|overwrite"):
        fitted.save(str(tmp_path / "fitted"))


def test_orientation(cloud):
    normal = iforest.IsolationForest(numTrees=20, orientation="raw").fit(cloud)
    assert normal.transform(cloud).filter("int(event_time) < 15").agg(F.max("score")).first()[0] < 0.3


def test_forest_on_few_equal_rows(spark, cloud):
    few = cloud.limit(1).select("symbol", "event_time", *[F.lit(1.0).alias(c) for c in FEATURE_COLS])
    model = iforest.IsolationForest(numTrees=5).fit(few)
    assert [r.score for r in model.transform(few).collect()] == [0.0]
    with pytest.raises(ValueError):
        iforest.IsolationForest().fit(few.limit(0))


def test_average_path():
    harmonic = math.log(255) + 0.5772156649015329
    assert iforest.average_path([0, 1, 2, 256]).tolist() == pytest.approx([0, 0, 1, 2 * harmonic - 2 * 255 / 256])


def test_minmax(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (4.0,)], "raw double")
    assert [r.score for r in iforest.minmax_scores(df, "raw").collect()] == [1.0, 0.75, 0.0]
    assert [r.score for r in iforest.minmax_scores(df, "raw", "raw").collect()] == [0.0, 0.25, 1.0]
    outside = df.select(iforest.scaled_score(F.col("raw"), 1.0, 2.0).alias("x"))
    assert [r.x for r in outside.collect()] == [1.0, 1.0, 0.0]


def test_scores_of_signals(spark, trades, cloud):
    df = trades([("a", t, 10 + t % 3, 1) for t in range(50)])
    signals = spark.createDataFrame([("a", 49_000, 49, "x"), ("zz", 1, 1, "y")], "symbol string, trade_ts bigint, seq bigint, tag string")
    recent = features.feature_recent(df, 100, 10_000, signals)
    assert {r.ml_anomaly_score for r in iforest.score_signals(signals, recent, None).collect()} == {None}
    got = {r.tag: r.ml_anomaly_score for r in iforest.score_signals(signals, recent, iforest.IsolationForest(numTrees=5).fit(cloud)).collect()}
    assert got["y"] is None
    assert 0 <= got["x"] <= 1


def test_report(spark, tmp_path):
    data = [("a", 0.1), ("a", 0.6), ("b", 0.5), ("b", 0.4)]
    df = spark.createDataFrame(data, "symbol string, score double")
    report = evaluation.report(df)
    r = report.first()
    assert (r.anomaly_rate, r.score_p50, r.score_p90, r.score_p99, r.n_records) == (0.25, 0.45, 0.57, 0.597, 4)
    assert r.symbol_anomaly_rates == {"a": 0.5, "b": 0.0}
    report.coalesce(1).write.json(str(tmp_path / "report"))
    (text,) = (x for f in (tmp_path / "report").glob("*.json") for x in f.read_text().splitlines())
    assert json.loads(text)["symbol_anomaly_rates"] == {"a": 0.5, "b": 0.0}


@pytest.mark.parametrize("rate, passed", [(0.03, True), (0.2, True), (0.0299, False), (0.2001, False)])
def test_gate(spark, rate, passed):
    (r,) = evaluation.gate(spark.createDataFrame([(rate,)], "anomaly_rate double")).collect()
    assert r.passed is passed


def test_versions(spark, tmp_path):
    registry = evaluation.ModelRegistry(spark, str(tmp_path / "versions"))
    at = datetime(2024, 1, 1)
    assert registry.register("m0", 0.5, at) is None
    assert registry.approved().count() == 0
    assert [registry.register(f"m{i}", 0.1, at + timedelta(days=i)) for i in (1, 2)] == [1, 2]
    registry.approve(1, at + timedelta(days=3))
    assert registry.approved().first().path == "m1"
    registry.approve(2, at + timedelta(days=4))
    assert registry.approved().first().path == "m2"
    assert registry.current().count() == 2


def test_training_from_the_archive(spark, tmp_path):
    from tradeloom.config import Settings
    from tradeloom.plans import training

    rng, now = random.Random(1), datetime(2024, 1, 20)
    end = int((now - datetime(1970, 1, 1)).total_seconds() * 1000)
    lines = []
    for i in range(4000):
        t = end - 1000 - (i * 431) % (16 * 86_400) * 1000
        lines.append((json.dumps({"s": rng.choice("ab"), "p": round(rng.gauss(100, 1), 2), "v": rng.randrange(1, 9), "t": t}), t))
    df = spark.createDataFrame(lines, "value string, t bigint")
    bronze = str(tmp_path / "bronze")
    medallion.write_bronze(df, F.to_date(F.timestamp_millis("t")).cast("timestamp"), bronze)

    registry = evaluation.ModelRegistry(spark, str(tmp_path / "versions"))
    version = training.run(spark, bronze, str(tmp_path / "work"), registry, now, Settings(), numTrees=20)
    rows = medallion.read_feature_csv(spark, str(tmp_path / "work" / "features"))
    oldest = rows.agg(F.min("event_time")).first()[0]
    assert oldest >= "2024-01-06T00:00:00Z"
    assert {r.split for r in rows.select("split").distinct().collect()} == {"train", "validation"}
    (text,) = [x for f in (tmp_path / "work" / "report").glob("*.json") for x in f.read_text().splitlines()]
    result = json.loads(text)
    assert result["n_records"] == rows.filter("split = 'validation'").count()
    assert (version is not None) == (0.03 <= result["anomaly_rate"] <= 0.2)


def test_arrival_numbers_of_archived_trades(spark, tmp_path):
    df = spark.createDataFrame([("a", 2.0, 1.0, 5), ("a", 1.0, 1.0, 5), ("a", 1.0, 1.0, 6), ("a", 2.0, 1.0, 5)], "s string, p double, v double, t bigint")
    medallion.store_trades(df, str(tmp_path / "t"))
    got = spark.read.parquet(str(tmp_path / "t")).orderBy("t", "seq")
    assert [(r.t, r.seq, r.p) for r in got.collect()] == [(5, 0, 1.0), (5, 1, 2.0), (5, 2, 2.0), (6, 0, 1.0)]


@pytest.mark.parametrize("rate", [0.02, 0.3, 1.0])
def test_each_tree_draws_its_share(spark, rate):
    """Lots are uniform below the rate, and trees draw apart from each other."""
    rows = spark.range(4000).withColumnRenamed("id", "k")
    drawn = iforest._tree_draws(rows, "k", 42, 20, rate).select("k", "_draw.tree", "_draw.lot").toPandas()
    assert drawn.groupby(["k", "tree"]).size().max() == 1
    per_tree = drawn.groupby("tree").size().reindex(range(20), fill_value=0)
    spread = 5 * math.sqrt(4000 * rate * (1 - rate)) + 1e-9
    assert (abs(per_tree - 4000 * rate) <= spread).all()
    assert drawn["lot"].between(0, rate).all() and abs(drawn["lot"].mean() - rate / 2) < 0.05 * rate
    if rate < 1:  # two trees share rate * rate of the rows
        both = drawn.pivot_table(index="k", columns="tree", values="lot", aggfunc="size", fill_value=0).reindex(range(4000), fill_value=0)
        pairs = [int((both[i] & both[j]).sum()) for i, j in ((0, 1), (3, 17), (8, 9))]
        assert all(abs(n - 4000 * rate**2) <= 5 * math.sqrt(4000 * rate**2) + 1 for n in pairs)
