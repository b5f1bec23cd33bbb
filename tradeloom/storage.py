"""Where jobs put their stage tables: the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import hashlib
import tempfile
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session without one gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tradeloom-")
    return _local_roots[app]


class Stage:
    """A folder of Parquet tables, each computed once per application and then read back.

    Writing a small pre-aggregated table cuts the lineage: later steps read it instead of scanning the
    trades again, and a lost executor costs a re-read, not a recomputation.
    """

    def __init__(self, spark: SparkSession, name: str):
        tag = hashlib.sha256(name.encode()).hexdigest()[:16]
        self.spark = spark
        self.path = f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{tag}"
        self._schemas: dict[str, StructType] = {}
        self._folders: set[str] = set()
        self._lock = threading.RLock()

    def table(self, name: str, build, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.path}/{name}"
        with self._lock:
            if name not in self._schemas:
                rows = build()
                rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
                self._schemas[name] = rows.schema
        # The schema is given, since an empty table has no file to read it from.
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    def folder(self, name: str, write) -> str:
        """A folder in another format: ``write(path)`` runs once, then the path is handed out."""
        path = f"{self.path}/{name}"
        with self._lock:
            if name not in self._folders:
                write(path)
                self._folders.add(name)
        return path
