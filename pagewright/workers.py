"""Makes this package importable in Python workers started from a source checkout."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def reachable(spark: SparkSession) -> SparkSession:
    """Put the checkout on the workers' module path; on a cluster, ship the package with --py-files as well."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark
