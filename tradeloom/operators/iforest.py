"""Isolation forest (Liu, Ting, Zhou 2008) as a Spark ML estimator.

Trees are grown from small samples, one group per tree on the executors. The fitted forest is a table with a
row per node, at most ``trees * (2 * sample - 1)`` rows, so it may be broadcast whatever was trained on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.schemas import FEATURE_COLS

NODES = (
    "tree int, node int, feature int, threshold double, left_node int, right_node int, depth int, size int, "
    "sample_size int"
)
_EULER = 0.5772156649015329


def average_path(n):
    """Mean depth of an unsuccessful search among n points, c(n) of the paper."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        c = 2.0 * (np.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n
    return np.where(n > 2, c, np.where(n == 2, 1.0, 0.0))


def grow_tree(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes ``(node, feature, threshold, left, right, depth, size)``; leaves have feature -1."""
    nodes: list[tuple] = []
    waiting = [(0, np.arange(len(points)), 0)]
    used = 1
    while waiting:
        node, members, depth = waiting.pop()
        here = points[members]
        low, high = here.min(axis=0), here.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= max_depth or len(members) <= 1 or len(splittable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth, len(members)))
            continue
        feature = int(rng.choice(splittable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = here[:, feature] < threshold
        if not goes_left.any() or goes_left.all():
            goes_left = here[:, feature] <= low[feature]
            threshold = float(np.nextafter(low[feature], np.inf))
        left, right, used = used, used + 1, used + 2
        nodes.append((node, feature, threshold, left, right, depth, len(members)))
        waiting.append((left, members[goes_left], depth + 1))
        waiting.append((right, members[~goes_left], depth + 1))
    return nodes


def _tree_draws(rows: DataFrame, key: str, seed: int, trees: int, rate: float) -> DataFrame:
    """A row for each tree that draws a row, with its ``lot``. A row's lots depend on its key and the seed only.

    One hash tells the first tree that draws the row, by the gap to it, and most rows are drawn by none and go at once;
    only the others are hashed for the trees after that.
    """

    def lot(*what) -> Column:
        bits = 2**53
        return F.xxhash64(F.col(key), F.lit(seed), *what).bitwiseAND(F.lit(bits - 1)) / F.lit(float(bits))

    none_before = math.log1p(-rate) if rate < 1 else -math.inf
    gap = F.floor(F.log1p(-lot(F.lit("first"))) / none_before) if rate < 1 else F.lit(0)
    drawn = rows.withColumn("_first", gap).filter(F.col("_first") < trees)
    later = F.when(F.col("_first") + 1 < trees, F.sequence(F.col("_first") + 1, F.lit(trees - 1).cast("bigint")))
    lots = F.transform(
        F.coalesce(later, F.array().cast("array<bigint>")), lambda tree: F.struct(tree.alias("tree"), lot(tree).alias("lot"))
    )
    first = F.struct(F.col("_first").cast("bigint").alias("tree"), (lot(F.col("_first")) * rate).alias("lot"))
    all_lots = F.concat(F.array(first), F.filter(lots, lambda x: x["lot"] < rate))
    return drawn.withColumn("_draw", F.explode(all_lots)).drop("_first")


class _ForestParams(Params):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    sampleSize = Param(Params._dummy(), "sampleSize", "rows per tree", TypeConverters.toInt)
    contamination = Param(Params._dummy(), "contamination", "expected share of anomalies", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    orientation = Param(
        Params._dummy(), "orientation", "anomaly: 1 is most anomalous; raw: 1 is most normal", TypeConverters.toString
    )

    keyColumns = Param(Params._dummy(), "keyColumns", "columns that identify a row", TypeConverters.toListString)

    def _defaults(self) -> None:
        self._setDefault(
            numTrees=200, sampleSize=256, contamination=0.1, seed=42, orientation="anomaly", keyColumns=["symbol", "event_time"]
        )


class IsolationForest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits on the nine feature columns. ``key`` columns must identify a row; they decide its lots.

    Like the model it can be a stage of a ``Pipeline``, which is saved and loaded whole.
    """

    def __init__(self, key=("symbol", "event_time"), **params):
        super().__init__()
        self._defaults()
        self._set(keyColumns=list(key), **params)

    @property
    def key(self) -> tuple[str, ...]:
        return tuple(self.getOrDefault(self.keyColumns))

    def _fit(self, dataset: DataFrame) -> IsolationForestModel:
        trees, wanted, seed = (self.getOrDefault(p) for p in (self.numTrees, self.sampleSize, self.seed))
        columns = list(FEATURE_COLS)
        rows = dataset.select(F.struct(*self.key).alias("_key"), *[F.col(c).cast("double") for c in columns]).persist()
        try:
            total = rows.count()
            if total == 0:
                raise ValueError("no rows to train on")
            sample = min(wanted, total)
            # Each tree is offered a few standard deviations more rows than it takes.
            rate = min(1.0, (sample + 8.0 * math.sqrt(sample)) / total)
            draws = _tree_draws(rows, "_key", seed, trees, rate).select(
                F.col("_draw.tree").cast("int").alias("tree"), F.col("_draw.lot").alias("lot"), *columns
            )
            max_depth = math.ceil(math.log2(max(sample, 2)))

            def build(group: pd.DataFrame) -> pd.DataFrame:
                tree = int(group["tree"].iloc[0])
                values = group[["lot", *columns]].to_numpy(dtype=float)
                points = values[np.lexsort(values.T[::-1])][:sample, 1:]
                nodes = grow_tree(points, np.random.default_rng([seed, tree]), max_depth)
                names = ["node", "feature", "threshold", "left_node", "right_node", "depth", "size"]
                out = pd.DataFrame(nodes, columns=names)
                out.insert(0, "tree", tree)
                return out.assign(sample_size=len(points))

            # A group is one tree's offer of a few hundred rows. The nodes are collected: their number is
            # bounded by trees and sample size, and scoring sends them to every executor anyway.
            tasks = min(trees, dataset.sparkSession.sparkContext.defaultParallelism)
            grown = draws.repartition(tasks, "tree").groupBy("tree").applyInPandas(build, NODES)
            nodes = grown.toPandas().sort_values(["tree", "node"], ignore_index=True)
            model = self._copyValues(IsolationForestModel(nodes, 0.0, 1.0))
            ends = model.raw(rows).agg(F.min("raw").alias("low"), F.max("raw").alias("high")).first()
        finally:
            rows.unpersist()
        model.low, model.high = float(ends["low"]), float(ends["high"])
        return model


class IsolationForestModel(Model, _ForestParams, MLReadable, MLWritable):
    """Adds ``raw`` (larger is more normal, as a decision function) and ``score`` in [0, 1]."""

    def __init__(self, nodes: pd.DataFrame, low: float, high: float, **params):
        super().__init__()
        self._defaults()
        self._set(**params)
        self.nodes, self.low, self.high = nodes, low, high

    def raw(self, rows: DataFrame) -> DataFrame:
        packed = pack_forest(self.nodes)

        @F.pandas_udf("double")
        def decision(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
                yield pd.Series(-anomaly(points, packed))

        return rows.withColumn("raw", decision(*[F.col(c).cast("double") for c in FEATURE_COLS]))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.raw(dataset).withColumn(
            "score", scaled_score(F.col("raw"), self.low, self.high, self.getOrDefault(self.orientation))
        )

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader(cls)

    def save(self, *where) -> None:
        """``save(path)``, in place of what lies there; a session may come first."""
        self.write().overwrite().save(where[-1])

    @classmethod
    def load(cls, *where) -> IsolationForestModel:
        """``load(path)``; a session may come first."""
        return cls.read().load(where[-1])


class _ForestWriter(MLWriter):
    """The parameters and the ends of the training scores as Spark's metadata, the nodes as Parquet."""

    def __init__(self, model: IsolationForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        ends = {"low": self.model.low, "high": self.model.high}
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata=ends)
        spark.createDataFrame(self.model.nodes, NODES).write.parquet(f"{path}/nodes")


class _ForestReader(MLReader):
    def __init__(self, kind: type[IsolationForestModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> IsolationForestModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        model = self.kind(nodes, metadata["low"], metadata["high"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def pack_forest(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """Node columns as arrays over all trees; children become positions in these arrays."""
    ordered = nodes.sort_values(["tree", "node"])
    starts = ordered.groupby("tree")["node"].size().cumsum().shift(fill_value=0)
    offset = ordered["tree"].map(starts).to_numpy()
    leaf = ordered["feature"].to_numpy() < 0
    own = np.arange(len(ordered))
    sizes = ordered.groupby("tree")["sample_size"].first().to_numpy()
    return {
        "roots": starts.to_numpy(),
        "feature": np.where(leaf, 0, ordered["feature"].to_numpy()),
        "threshold": np.where(leaf, -np.inf, ordered["threshold"].to_numpy()),
        "left": np.where(leaf, own, ordered["left_node"].to_numpy() + offset),
        "right": np.where(leaf, own, ordered["right_node"].to_numpy() + offset),
        "length": ordered["depth"].to_numpy() + np.where(leaf, average_path(ordered["size"].to_numpy()), 0.0),
        "depth": np.array([ordered["depth"].max()]),
        "norm": np.array([max(float(average_path(sizes).mean()), 1e-12)]),
    }


def anomaly(points: np.ndarray, forest: dict[str, np.ndarray]) -> np.ndarray:
    """``2 ** (-E[h(x)] / c(sample))`` for each point."""
    scores = np.empty(len(points))
    for start in range(0, len(points), 1024):
        part = points[start : start + 1024]
        rows = np.arange(len(part))[:, None]
        at = np.tile(forest["roots"], (len(part), 1))
        for _ in range(int(forest["depth"][0])):
            goes_left = part[rows, forest["feature"][at]] < forest["threshold"][at]
            at = np.where(goes_left, forest["left"][at], forest["right"][at])
        scores[start : start + 1024] = 2.0 ** (-forest["length"][at].mean(axis=1) / forest["norm"][0])
    return scores


def scaled_score(raw: Column, low, high, orientation: str = "anomaly") -> Column:
    """Min-max scale a decision value and clip it to [0, 1].

    ``anomaly`` gives 1 to the lowest, most anomalous value; ``raw`` keeps the direction of the decision.
    """
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    position = (high - raw) if orientation == "anomaly" else (raw - low)
    scaled = F.coalesce(F.try_divide(position, high - low), F.lit(0.0))
    return F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))


def minmax_scores(rows: DataFrame, raw: str, orientation: str = "anomaly") -> DataFrame:
    """Scale a column by its own ends."""
    ends = rows.agg(F.min(raw).alias("low"), F.max(raw).alias("high")).first()
    if ends["low"] is None:
        return rows.withColumn("score", F.lit(None).cast("double"))
    return rows.withColumn("score", scaled_score(F.col(raw), ends["low"], ends["high"], orientation))


def score_signals(signals: DataFrame, features: DataFrame, model: IsolationForestModel | None) -> DataFrame:
    """Attach the score of the latest trades at each signal; no model or no features leave it null.

    ``features`` comes from ``feature_recent`` with these signals, so only their rows reach the forest.
    """
    if model is None:
        return signals.withColumn("ml_anomaly_score", F.lit(None).cast("double"))
    scored = model.transform(features).select(
        "symbol", F.col("t").alias("trade_ts"), "seq", F.col("score").alias("ml_anomaly_score")
    )
    return signals.drop("ml_anomaly_score").join(scored, ["symbol", "trade_ts", "seq"], "left")
