"""Session construction and the shared checkpoint folder.

The settings below are the ones the jobs rely on at scale:

* AQE on: it re-plans joins from real shuffle sizes (a dimension that turns
  out small becomes a broadcast at runtime), coalesces small shuffle
  partitions and splits skewed join partitions.
* ``autoBroadcastJoinThreshold`` stays a *size check*: Spark only broadcasts a
  side whose estimated (plan time) or measured (AQE) size is below it and
  falls back to a sort-merge join beyond it.  No job calls ``broadcast()`` on
  a side whose size is not bounded.
* UTC session time zone, so day boundaries do not depend on the host.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# SQL settings the jobs rely on, from a laptop to a large cluster.  They are
# applied to the running session only where the deployment has not set them
# (``spark-submit --conf`` / spark-defaults win).
DEFAULT_SQL_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}

# Core settings for cluster runs.  Only the launcher can set them (they are
# fixed when the application starts), so they are passed to spark-submit,
# see ``submit_conf_args``:
# * graceful decommissioning, so shuffle and cached blocks of an executor
#   that is being taken away migrate instead of forcing stage re-runs;
# * more task and stage attempts for long jobs on preemptible capacity.
CLUSTER_SUBMIT_CONF: dict[str, str] = {
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    # a high starting width: AQE joins small partitions but can't widen a
    # stage, so the start must fit the largest shuffle (about its bytes
    # divided by 256 MB); broadcast sides are bounded for executors' memory
    # and estimated from compressed files
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.autoBroadcastJoinThreshold": "256m",
    "spark.sql.sources.fileCompressionFactor": "3.0",
}

# Local runs (tests, benchmarks): no web UI, no progress bar.
LOCAL_CONF: dict[str, str] = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

def submit_conf_args(conf: dict[str, str] | None = None) -> list[str]:
    """``--conf k=v`` arguments for spark-submit (the cluster core settings)."""
    out: list[str] = []
    for k, v in (conf or CLUSTER_SUBMIT_CONF).items():
        out += ["--conf", f"{k}={v}"]
    return out


def build_session(
    master: str | None = None,
    app_name: str = "martwright",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the job defaults applied.

    ``master`` is only set when given: on a cluster the launcher decides it.
    Defaults never override what the deployment configured; ``extra_conf``
    and ``shuffle_partitions`` (explicit arguments) always apply.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            for key, value in LOCAL_CONF.items():
                builder = builder.config(key, value)
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")

    deployed = spark.sparkContext.getConf()
    for key, value in DEFAULT_SQL_CONF.items():
        if not deployed.contains(key) and key not in (extra_conf or {}):
            spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever the deployment put in
    ``spark.checkpoint.dir`` (a shared file system every executor sees).  Only
    when nothing is configured -- local runs and tests -- a fresh scratch
    folder is created and registered.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():  # Spark normally registers it at start-up
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared "
            "checkpoint folder"
        )
    # local runs and tests only (the setting itself cannot change at runtime)
    local = tempfile.mkdtemp(prefix="martwright-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local
