"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps stay TIMESTAMP_NTZ (UTC wall
# clock) end to end; the UTC session zone only matters for zoned text input.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}

# Runtime SQL settings the jobs need whatever session they are given.
# Constraint propagation is off: on the wide CASE / JSON projections of the
# decoder it dominates planning time (PruneFilters) and buys nothing here.
RUNTIME_CONF = {
    "spark.sql.constraintPropagation.enabled": "false",
    # HotSpot never compiles a method of more than 8,000 bytes of code: above it,
    # a fused stage would be interpreted row by row. Spark then runs the stage's
    # operators apart, their expressions split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Settings for the large-cluster runs (100 TB class inputs). Applied by the
# job entry points to keys the cluster has not set itself:
# * many initial shuffle partitions, coalesced by AQE to ~256 MB each, so a
#   stage never has to hold more than a few hundred MB per task;
# * AQE skew join: a partition 5x the median and over 512 MB is split (one
#   merchant or subscription may hold a third of the rows);
# * 256 MB input splits; broadcast only under the 64 MB runtime size check.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_cluster_defaults(spark: SparkSession) -> SparkSession:
    """Set CLUSTER_CONF keys the session does not define explicitly."""
    current = dict(spark.sparkContext.getConf().getAll())
    for k, v in CLUSTER_CONF.items():
        if k not in current:
            spark.conf.set(k, v)
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str = "local[8]", app: str = "recurra",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # local mode runs every task inside the driver JVM: its heap is the
        # executors' memory (the 1 GB default makes 8 threads GC-bound)
        conf["spark.driver.memory"] = os.environ.get("RECURRA_DRIVER_MEMORY", "16g")
    conf.update(RUNTIME_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job state.

    The folder the session names in ``spark.checkpoint.dir``, or the one set in
    code on the context. Where neither is set, a local session gets a scratch
    folder of its own; on a cluster that is an error, since executors cannot
    see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local($|\[)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder "
                           "that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="recurra-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")
