"""Session settings the jobs are written for, and the shared folder."""

from __future__ import annotations

import re
import tempfile
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys in the shuffled joins are split by the adaptive planner, also when the
    # split costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture costs several driver round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "ledgerline", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with ``SETTINGS``. ``input_bytes``: the expected size of the largest input, from
    which shuffles start with a partition for each 128 MB; adaptive execution merges, never splits.
    """
    if input_bytes:
        extra.setdefault("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(200, input_bytes >> 27)))
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"ledgerline-{application_id}-")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a shared folder; executors cannot read a machine-local one")
    return _local_dir(spark.sparkContext.applicationId)
