"""Severity of toxic language by cumulative-link ordinal regression on sparse word features.

For grades 0 < 1 < ... < K the model is P(grade <= k) = 1 / (1 + exp(w . x - cut_k)): one weight vector shared by all
thresholds, and rising cuts. Features are hashed words and the beginnings of words; x holds 1 + log(count) for
those present. Only features
whose share of toxic and of clean documents differs beyond chance are used, so w is sparse and most words of most
texts weigh nothing. The expected severity is the sum of P(grade > k) over all k.

Fitting uses a bounded sample: at most ``SAMPLE`` labelled documents, those of least hash, chosen before texts are read,
and at most ``SELECTED`` features; one task fits them. Scoring looks at every word of every text, in one pass
without a shuffle.

A null or empty text has no features and is judged by the cuts alone. With no labels, or labels of one grade, there is
nothing to learn: severity is 0 and every document is kept. Of several labels of a document the highest counts. Labels
without a document, or null ones, count for nothing. Repeated rows and null ids are scored row by row; other
columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import keyed, stage
from tradeloom.llm.wordblocks import TEXTS_AT_ONCE, arrow, texts_of

SAMPLE = 20_000
BUCKETS = 1 << 20
#: Besides the whole word, its first so many bytes are features: inflected forms share them.
PREFIXES = (4, 5)
KINDS = 1 + len(PREFIXES)
SELECTED = 4096
#: Standard errors by which a feature's shares must differ, and documents that must hold it.
BEYOND_CHANCE, LEAST_DOCS = 5.0, 5
STEPS, RATE, RIDGE = 300, 0.3, 1e-4
#: A toxic document with so many marked words is graded 2, as the labels tell toxic from clean only.
SEVERE = 3
KEPT_WORDS = 300_000

FEATURES = "grade int, buckets array<int>, counts array<int>"
WEIGHTS = "cuts array<double>, weights array<double>"
SCORES = "doc_id bigint, severity double, toxicity double, grade int, kept boolean"

_EDGES = b".,;:!?\"'()[]{}*_-"


class Buckets(dict):
    """word -> features. Marks around a word are taken off, so that "word," and "(word" are the same."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > KEPT_WORDS:
            self.clear()
        bare = word.strip(_EDGES) or word
        parts = [bare] + [bare[:n] for n in PREFIXES if len(bare) >= n]
        self[word] = found = self.chosen(k * BUCKETS + xxhash.xxh64_intdigest(p) % BUCKETS for k, p in enumerate(parts))
        return found

    def chosen(self, features) -> tuple[int, ...]:
        return tuple(features)


class Selected(Buckets):
    """Only the features that a model gives a weight."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def chosen(self, features) -> tuple[int, ...]:
        return tuple(f for f in features if f in self.weights)


def counted(text: bytes, buckets: Buckets) -> Counter:
    return Counter(chain.from_iterable(map(buckets.__getitem__, text.lower().split())))


def _features(sample: DataFrame) -> DataFrame:
    def run(batches):
        buckets = Buckets()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(at, TEXTS_AT_ONCE)
                found = [counted(t, buckets) for t in texts_of(some)]
                out = {"grade": some.column("grade"), "buckets": [list(c) for c in found], "counts": [list(c.values()) for c in found]}
                yield pa.RecordBatch.from_pydict(out, schema=arrow(FEATURES))

    return sample.select("grade", "text").mapInArrow(run, FEATURES)


def _selected(rows: DataFrame, n_toxic: int, n_clean: int) -> dict[int, float]:
    """Features by how many standard errors their share of toxic documents is above that of clean ones, as far as that
    is beyond chance; the ``SELECTED`` most telling at most."""
    toxic = F.col("grade") > 0
    counts = rows.select(toxic.cast("int").alias("toxic"), F.explode("buckets").alias("bucket")).groupBy("bucket")
    counts = counts.agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_DOCS)
    share = F.col("n") / (n_toxic + n_clean)
    error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / n_toxic + 1 / n_clean))
    score = (F.col("a") / n_toxic - (F.col("n") - F.col("a")) / n_clean) / error
    beyond = counts.select("bucket", score.alias("score")).filter(F.abs("score") >= BEYOND_CHANCE)
    return {r["bucket"]: r["score"] for r in beyond.orderBy(F.desc(F.abs("score")), "bucket").limit(SELECTED).collect()}


def fit_cumulative(rows, columns, values, grades: np.ndarray, n_columns: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of least mean loss, by gradient steps with momentum and per-parameter rates.

    The cuts are kept in order as a first cut and the logarithms of the gaps above it.
    """
    n = len(grades)
    w, base, gaps = np.zeros(n_columns), np.array([1.0]), np.zeros(top - 1)
    params = np.concatenate([w, base, gaps])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, cuts = params[:n_columns], np.cumsum(np.concatenate([params[n_columns : n_columns + 1], np.exp(params[n_columns + 1 :])]))
        x = np.bincount(rows, weights=values * w[columns], minlength=n)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper, lower = _logistic(edges[grades + 1] - x), _logistic(edges[grades] - x)
        p = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
        d_x = (d_upper - d_lower) / n  # of the mean loss, -log p
        d_cuts = np.array([((grades == k + 1) * d_lower - (grades == k) * d_upper).sum() / n for k in range(top)])
        d_w = np.bincount(columns, weights=values * d_x[rows], minlength=n_columns) + RIDGE * w
        d_gaps = np.array([d_cuts[k:].sum() for k in range(1, top)]) * np.exp(params[n_columns + 1 :])
        slope = np.concatenate([d_w, [d_cuts.sum()], d_gaps])
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        params = params - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    cuts = np.cumsum(np.concatenate([params[n_columns : n_columns + 1], np.exp(params[n_columns + 1 :])]))
    return params[:n_columns], cuts


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _fit_rows(batches, scores: dict[int, float]) -> tuple[list[float], list[float]]:
    """Cuts, and weights in the order of ``scores``, from documents with their selected features only."""
    good = np.array(sorted(scores))
    score = np.array([scores[b] for b in good.tolist()])
    grades, lengths, columns, counts = [], [], [], []
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            some = batch.slice(at, TEXTS_AT_ONCE)
            grades.append(some.column("grade").to_numpy(zero_copy_only=False))
            buckets = some.column("buckets").flatten().to_numpy()
            column = np.minimum(np.searchsorted(good, buckets), len(good) - 1)
            own = good[column] == buckets
            sizes = some.column("buckets").value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            kept = np.concatenate([[0], np.cumsum(own)])
            lengths.append(kept[ends] - kept[ends - sizes])
            columns.append(column[own])
            counts.append(some.column("counts").flatten().to_numpy()[own])
    grades, columns, counts = np.concatenate(grades), np.concatenate(columns), np.concatenate(counts)
    rows = np.repeat(np.arange(len(grades)), np.concatenate(lengths))
    if grades.max() == 1:  # labels without degrees: toxic documents with many marked words are graded 2
        toxic = grades > 0
        for kind in range(KINDS):
            mark = (score[columns] > 0) & (good[columns] // BUCKETS == kind)
            marked = np.bincount(rows, weights=counts * mark, minlength=len(grades))
            grades = np.where(toxic & (marked >= SEVERE), 2, grades)
    w, cuts = fit_cumulative(rows, columns, 1 + np.log(counts), grades.astype(np.int64), len(good), int(grades.max()))
    return cuts.tolist(), w.tolist()


class Model:
    """Rising cuts and the weights of the features that were selected."""

    def __init__(self, cuts: list[float], weights: dict[int, float]):
        self.cuts, self.weights = cuts, weights

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame) -> Model:
        """``labels``: doc_id, and ``grade`` from 0 up."""
        own = labels.filter("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
        sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)  # at most SAMPLE narrow rows: safe to broadcast
        texts = keyed(docs).join(F.broadcast(sample), "doc_id")
        rows = stage(_features(texts), "features")

        totals = rows.agg(F.count_if(F.col("grade") > 0), F.count_if(F.col("grade") <= 0)).first()
        scores = _selected(rows, *totals) if all(totals) else {}
        if not scores:
            return cls([], {})

        def fit(batches):
            cuts, weights = _fit_rows(batches, scores)
            yield pa.RecordBatch.from_pydict({"cuts": [cuts], "weights": [weights]}, schema=arrow(WEIGHTS))

        found = rows.coalesce(1).mapInArrow(fit, WEIGHTS).first()
        return cls(list(found["cuts"]), dict(zip(sorted(scores), found["weights"], strict=True)))

    def scorer(self):
        """A function from a text to (severity, toxicity, grade), for use within one task."""
        weights, cuts = self.weights, self.cuts
        selected = Selected(weights)

        def score(text: bytes) -> tuple[float, float, int]:
            if not cuts:
                return 0.0, 0.0, 0
            x = sum(weights[b] * (1 + math.log(n)) for b, n in sorted(counted(text, selected).items()))
            above = [1 / (1 + math.exp(max(-500.0, min(500.0, c - x)))) for c in cuts]
            return sum(above), above[0], sum(p >= 0.5 for p in above)

        return score


def grades(labels: DataFrame) -> DataFrame:
    """The table ``labels`` as grades: 0 clean, 1 toxic."""
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("grade"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected severity, chance of any toxicity, grade, and kept (clean is likelier than toxic)."""

    def run(batches):
        of = model.scorer()
        for batch in batches:
            found = [of(t) for t in texts_of(batch)]
            out = {"doc_id": batch.column("doc_id"), "severity": [f[0] for f in found], "toxicity": [f[1] for f in found]}
            out |= {"grade": [f[2] for f in found], "kept": [f[1] < 0.5 for f in found]}
            yield pa.RecordBatch.from_pydict(out, schema=arrow(SCORES))

    return keyed(docs).mapInArrow(run, SCORES)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose ``text`` isn't toxic, with all their columns."""

    def run(batches):
        of = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array([of(t)[1] < 0.5 for t in texts_of(batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
