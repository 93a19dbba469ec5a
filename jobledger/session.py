"""Session construction and the few session settings every operator relies on.

Operators never build their own session; they take the caller's and only set
runtime SQL confs that change results (time zone, duplicate JSON keys).
Cluster-sized confs (shuffle partitions, file split size, AQE) are set here
for local runs and left to the cluster's defaults otherwise.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Confs that change *results*: set on every session an operator sees.
RESULT_CONFS = {
    # all timestamps are compared and printed in UTC (RFC3339 "Z" on the wire)
    "spark.sql.session.timeZone": "UTC",
    # a JSON object with a repeated key keeps the last value, like a Go decoder
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Confs that only change *how* the plan runs: AQE re-plans joins from runtime
# sizes, splits skewed shuffle partitions and coalesces small ones.
PLAN_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # broadcast only what the planner has measured below this size
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def ship_code() -> None:
    """Let Python workers run this package's functions without importing it:
    functions of ``jobledger`` used inside ``mapInPandas`` / ``applyInPandas``
    are pickled by value, so executors need no install or path setup."""
    import pyspark.cloudpickle as cloudpickle

    import jobledger

    try:
        cloudpickle.register_pickle_by_value(jobledger)
    except ValueError:
        pass  # already registered


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the result-changing confs to an existing session (idempotent)."""
    for key, value in RESULT_CONFS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_code()
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A session on one machine (``local[...]``) that names none gets a private
    folder, removed at exit; on a cluster a missing setting is an error,
    because executors do not share a machine's own folders.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="jobledger-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def get_session(master: str | None = None, app: str = "jobledger",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session builder. On a cluster, pass the cluster's session in."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("JOBLEDGER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    for key, value in {**RESULT_CONFS, **PLAN_CONFS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)
