"""Evaluation report, acceptance gate and model versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.columns import half_even
from tradeloom.functions.percentiles import exact_percentiles

# The score from which a row counts as anomalous, and the accepted anomaly rates.
ANOMALOUS = 0.5
ACCEPT = (0.03, 0.20)
VERSIONS = "version bigint, path string, anomaly_rate double, status string, created_at timestamp"


def _rate(score: str) -> Column:
    return half_even(F.avg((F.col(score) > ANOMALOUS).cast("double")), 4)


def rates_by_symbol(scored: DataFrame, score: str = "score") -> DataFrame:
    return scored.groupBy("symbol").agg(_rate(score).alias("anomaly_rate"), F.count(F.lit(1)).alias("n_records"))


def report(scored: DataFrame, score: str = "score") -> DataFrame:
    """One row: anomaly rate, score percentiles, record count and the rate of each symbol as a map."""
    whole = scored.agg(_rate(score).alias("anomaly_rate"), F.count(F.lit(1)).alias("n_records"))
    spread = exact_percentiles(scored, score, {"score_p50": 0.5, "score_p90": 0.9, "score_p99": 0.99})
    # One entry per symbol, so this list is as long as the symbol domain.
    symbols = rates_by_symbol(scored, score).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", "anomaly_rate")))).alias("symbol_anomaly_rates")
    )
    # Three one-row results side by side.
    stacked = whole.unionByName(spread, True).unionByName(symbols, True)
    columns = ("anomaly_rate", "score_p50", "score_p90", "score_p99", "symbol_anomaly_rates", "n_records")
    row = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])
    return row.withColumns({c: half_even(F.col(c), 4) for c in columns if c.startswith("score_")})


def gate(report_row: DataFrame) -> DataFrame:
    """Register a model only when its anomaly rate lies in the accepted band, ends included."""
    passed = F.col("anomaly_rate").between(*ACCEPT)
    return report_row.select(
        "anomaly_rate", passed.alias("passed"), F.when(passed, "PendingManualApproval").otherwise("Rejected").alias("status")
    )


class ModelRegistry:
    """Append-only table of model versions; an approval is a further row of the same version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> DataFrame:
        try:
            return self.spark.read.schema(VERSIONS).parquet(self.path)
        except Exception as error:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], VERSIONS)

    def current(self) -> DataFrame:
        """The latest state of each version."""
        latest = F.max_by(F.struct("path", "anomaly_rate", "status", "created_at"), "created_at").alias("v")
        return self.versions().groupBy("version").agg(latest).select("version", "v.*")

    def _append(self, row: tuple) -> None:
        self.spark.createDataFrame([row], VERSIONS).coalesce(1).write.mode("append").parquet(self.path)

    def register(self, path: str, anomaly_rate: float, at: datetime) -> int | None:
        """A new version awaiting approval, or None when the rate is outside the accepted band."""
        if not ACCEPT[0] <= anomaly_rate <= ACCEPT[1]:
            return None
        version = (self.versions().agg(F.max("version")).first()[0] or 0) + 1
        while not self._claim(version):
            version += 1
        self._append((version, path, anomaly_rate, "PendingManualApproval", at))
        return version

    def _claim(self, version: int) -> bool:
        """Take a version number; a file that only one writer can create settles who gets it."""
        jvm = self.spark.sparkContext._jvm
        claim = jvm.org.apache.hadoop.fs.Path(f"{self.path}_claims/{version}")
        return claim.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(claim)

    def approve(self, version: int, at: datetime) -> None:
        row = self.current().filter(F.col("version") == version).first()
        self._append((version, row["path"], row["anomaly_rate"], "Approved", at))

    def approved(self) -> DataFrame:
        """The newest approved version, if any."""
        return self.current().filter(F.col("status") == "Approved").orderBy(F.desc("version")).limit(1)
