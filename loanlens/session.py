"""Spark session and checkpoint helpers.

The library never builds its own session inside an operator; callers pass one.
``get_spark`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run should carry. Shuffle partitions are sized per call site:
# a few per core locally, and at cluster scale ~ (shuffle bytes / 128 MB).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from planning-time size estimates; AQE turns a sort-merge
    # join into a broadcast join only from the measured size of a finished
    # shuffle stage (a proven size bound).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # reliable checkpoints (global ranks) are removed once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.files.maxPartitionBytes": "128MB",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "loanlens") -> SparkSession:
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    builder = builder.config("spark.driver.memory", os.environ.get("LOANLENS_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; it is read,
    never invented. Only a local-mode session with nothing configured (tests)
    gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="loanlens-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()
