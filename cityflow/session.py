"""Session settings the operators rely on.

Everything in the library works on any ``SparkSession``; these helpers only
pin the settings that change results (UTC session zone) or plans (AQE), and
find the shared folder used to cut lineage.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for results or for the shape of the plans.
RECOMMENDED_CONF = {
    # Dates and hour labels are derived in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, and turn joins into broadcasts only when the measured
    # size of a side is below the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture for error messages costs several JVM round trips per
    # Column call while plans are built; off for batch jobs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Starting points for a large cluster (hundreds of executors, ~100 TB input):
# many initial shuffle partitions that AQE coalesces to ~256 MB each, large
# scan splits, and skew splitting for joins where one key holds a large share
# of the rows. Apply with ``build_session(extra=CLUSTER_CONF)`` or the
# platform's job configuration.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "cityflow", extra: dict | None = None) -> SparkSession:
    """A session for tests, benchmarks and local runs.

    On a cluster the session comes from the platform; call
    :func:`ensure_checkpoint_dir` on it instead of building one here.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the cluster.

    The folder configured in ``spark.checkpoint.dir`` is used as is. Only
    when nothing is configured and the master is local (tests) a fresh
    scratch folder is made; on a cluster a missing setting is an error.
    """
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        # A machine-local folder would not survive the loss of an executor.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    local = tempfile.mkdtemp(prefix="cityflow-ckpt-", dir=os.environ.get("CITYFLOW_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and cut lineage.

    Used where a value must not be re-evaluated (generated ids, partition
    tags). A lost executor re-reads the checkpoint instead of recomputing a
    nondeterministic expression.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
