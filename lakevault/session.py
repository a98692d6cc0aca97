"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it turns joins with a measured small side into
# broadcasts, splits hot shuffle partitions of joins, and merges tiny shuffle partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Call-site capture for every column expression more than doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "lakevault", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots.

    The checkpoint folder is whatever the cluster names in ``spark.checkpoint.dir``;
    nothing is set here, callers without a cluster set their own.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
