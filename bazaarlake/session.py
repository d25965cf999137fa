"""Session settings and the shared folder for tables written on the way."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"

_local_dir: str | None = None


def local_session(cores: str | int = "*", app: str = "bazaarlake", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    partitions = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A folder of this machine is used only for a local master without that setting.
    """
    configured = spark.conf.get(SHARED_DIR_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_KEY} to a folder shared by all executors")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="bazaarlake-")
    return _local_dir
