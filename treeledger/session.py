"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# AQE does the sizing: it coalesces small partitions, splits skewed ones and turns a sort-merge join into a broadcast
# join only after it has seen the real size of the shuffled side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# For a large cluster: shuffles start with many partitions, so that each fits in memory at 100 TB, and AQE merges them
# up to the advisory size.  Sheet files are small, so a scan task takes more of them.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
}


def build_session(
    name: str = "treeledger", master: str | None = None, cluster: bool = False, **settings: str
) -> SparkSession:
    """A session with the settings above; keyword settings use ``__`` in place of dots and win over the others."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | (CLUSTER_SETTINGS if cluster else {})).items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder that the cluster names in ``spark.checkpoint.dir``.

    The setting is needed: executors do not see each other's local files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{root.rstrip('/')}/treeledger/{label}-{uuid.uuid4().hex}"
