"""Weak supervision: how far to trust rules that vote 1, -1 or abstain (0), found without labels.

Each rule's vote is taken to depend on the hidden class alone. Votes are counted by pattern, of which there are at
most 3 ** rules however many rows there are, and expectation-maximisation runs over the counted patterns: each
step is one aggregate that gives the class's weight under the present estimates, and new estimates follow from its sums.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS, ENOUGH = 25, 1e-4
#: Rows that the first estimate of each rule and class weighs: it rules where there are few rows, and keeps chances off 0.
PRIOR_ROWS = 10.0
VOTES = (-1, 0, 1)


class LabelModel:
    """Chances of each vote under the good class (1) and the other (0)."""

    def __init__(self, trust: dict[str, float], share: float = 0.9):
        """At first: the share of good rows, and how often each rule is right when it doesn't abstain."""
        self.rules, self.share = list(trust), share
        self.chances = {
            r: {1: {-1: (1 - t) / 2, 0: 0.5, 1: t / 2}, 0: {-1: t / 2, 0: 0.5, 1: (1 - t) / 2}} for r, t in trust.items()
        }
        self.first = self.chances

    def weights(self) -> dict[str, dict[int, float]]:
        """The log-odds that each vote adds."""
        return {r: {v: math.log(c[1][v] / c[0][v]) for v in VOTES} for r, c in self.chances.items()}

    def posterior(self, vote) -> Column:
        """The chance of the good class; ``vote(rule)`` gives the column of a rule's vote."""
        odds = F.lit(math.log(self.share / (1 - self.share)))
        for rule, w in self.weights().items():
            odds = odds + F.when(vote(rule) > 0, w[1]).when(vote(rule) < 0, w[-1]).otherwise(w[0])
        return 1 / (1 + F.exp(-odds))

    def fit(self, patterns: DataFrame) -> LabelModel:
        """``patterns`` has a column for each rule, and ``n``, the rows with that pattern."""
        for _ in range(STEPS):
            rows = patterns.withColumn("p", self.posterior(F.col))
            sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("good")]
            for i, rule in enumerate(self.rules):
                for v in VOTES:
                    hit = F.when(F.col(rule) == v, F.col("n")).otherwise(0)
                    sums += [F.sum(hit).alias(f"n_{i}_{v + 1}"), F.sum(hit * F.col("p")).alias(f"good_{i}_{v + 1}")]
            found = rows.agg(*sums).first()
            if not found["n"]:
                break
            before = self.share
            self.share = min(0.999, max(0.001, found["good"] / found["n"]))
            self.chances = {r: {} for r in self.rules}
            for i, rule in enumerate(self.rules):
                for c in (1, 0):
                    counts = {}
                    for v in VOTES:
                        good, n = found[f"good_{i}_{v + 1}"], found[f"n_{i}_{v + 1}"]
                        counts[v] = (good if c else n - good) + PRIOR_ROWS * self.first[rule][c][v]
                    total = sum(counts.values())
                    self.chances[rule][c] = {v: x / total for v, x in counts.items()}
            if abs(self.share - before) < ENOUGH:
                break
        return self
