"""SparkSession defaults for the warehouse jobs.

On a cluster the session comes from the platform and these calls only fill
in settings that are unset; `local_session` is for tests and benches.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions; UTC keeps date arithmetic stable.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # of compressed bytes: a line's keys take about ten of them, and in a task's
    # sorts and hash tables thirty times as many
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs the aggregate above an exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the SQL defaults that the session's launch settings leave open."""
    launched = spark.sparkContext.getConf()
    for k, v in _DEFAULTS.items():
        if k.startswith("spark.sql.") and not launched.contains(k):
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "duka") -> SparkSession:
    """A local session for tests and benches (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("DUKA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def get_session() -> SparkSession:
    """Return the active session, or a local one when none exists."""
    active = SparkSession.getActiveSession()
    if active is None:
        return local_session()
    ensure_checkpoint_dir(active)
    return active


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's `spark.checkpoint.dir`; only make our own when unset.

    A cluster names a shared folder there. A scratch folder is made only in
    local mode (tests); on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            # executors on other machines cannot read a driver-local folder
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf_dir = tempfile.mkdtemp(prefix="duka-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
