"""Spark-native analytics for trade streams: ingest, detectors, medallion tables, reports, anomaly scores."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
