"""Where intermediate results go: a folder that the driver and all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, else a folder of the warehouse, which a cluster shares too.

    Only a session that runs in one process (master local) gets a temporary folder where none is named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="spark-")
        return _LOCAL[app]
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/driftline-work"
