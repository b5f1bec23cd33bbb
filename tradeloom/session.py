"""A session with the settings the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, set the same options at submission."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tradeloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
