"""What Python tasks need: this package on their path."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers of this machine import the package wherever the driver was started.

    On a cluster the package is shipped as usual (``--py-files``) and the extra entry is ignored.
    """
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), ROOT])
    return spark
