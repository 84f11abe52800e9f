"""Spark session settings used by the jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at every scale: AQE re-plans joins and coalesces
# small shuffle partitions at run time, skew-join splitting handles hot keys,
# and timestamps are interpreted in UTC so results do not depend on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Local runs only: the heap of the single JVM (ignored once it is running;
# on a cluster executor memory comes from spark-submit).
LOCAL_DRIVER_MEMORY = "16g"


def build_session(master: str | None = None, app_name: str = "mirrorsmith",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the settings above.

    On a cluster the master and most sizing come from spark-submit; locally
    the shuffle partition count is kept close to the number of cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = LOCAL_DRIVER_MEMORY
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; only when it is unset on a
    local master (a test run) a fresh scratch folder is created and registered;
    on a cluster an unset folder is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: snapshots and landed pages "
                               "must not live in a machine-local temporary folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="mirrorsmith-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


@contextmanager
def writing(spark: SparkSession, **more: str):
    """While files are written: shuffle files go at the end of each statement,
    not when the driver happens to collect its garbage.  ``more`` are other
    settings for the time being (``_`` for ``.``)."""
    conf = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"} | {k.replace("_", "."): v for k, v in more.items()}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# Target bytes per task for scans and shuffles: large enough to amortise task
# overhead, small enough to sort and aggregate without heavy spill.
TARGET_PARTITION_BYTES = 256 << 20


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings for a job over ``input_bytes`` on ``total_cores`` cores.

    Shuffle partitions start at about one per ``TARGET_PARTITION_BYTES`` of
    input (at least two waves of tasks); AQE coalesces them at run time to the
    advisory size and splits skewed ones.  The count also fixes the bucket
    count of snapshots written in the session, so it should stay the same
    between refreshes of one mirror.
    """
    partitions = max(2 * total_cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES // 2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * TARGET_PARTITION_BYTES),
    }
