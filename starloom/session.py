"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: What the plans of the layers count on in any session (see ``settings_of_layers``).
LAYER_CONF = {
    # the JVM never compiles a method of more than 8000 bytes of byte code: the wide
    # projections of the staging models would be interpreted, row by row. Above
    # this, Spark evaluates them in many small methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # tables bucketed or shuffled by some of a join's keys are joined as they lie
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

# Settings the library's semantics depend on (null order, decimal scale and
# ANSI errors are spelled out per operator; these are the session-wide ones).
BASE_CONF = LAYER_CONF | {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE coalesces shuffle partitions toward this size (and splits skewed ones)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # Runtime re-plan: a join side measured under this size at runtime becomes
    # a broadcast; anything larger stays a shuffle join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # MIN/MAX/COUNT answered from Parquet footers where possible
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "starloom") -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    On a cluster ``master`` is left to spark-submit and the cluster's
    ``spark.sql.shuffle.partitions`` is kept (set it high; AQE coalesces
    toward the advisory size). In local mode it defaults to the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = os.cpu_count() or 8
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def settings_of_layers(spark: SparkSession) -> None:
    """Make the settings of the layers in a session that somebody else built."""
    for k, v in LAYER_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it (a shared filesystem path), and leaving it unset there is
    an error; only in local mode, as in tests, a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
