"""Session settings the rules depend on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results, so every job sets them.
REQUIRED_CONF = {
    # dates are taken from version times in UTC
    "spark.sql.session.timeZone": "UTC",
    # a repeated JSON key keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "papyra", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        # a few megabytes of version texts are seconds of date parsing: keep all cores on them
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def freed_shuffles(spark: SparkSession):
    """The shuffle files of each write within the block go when it ends, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Every executor must see it, so a machine-local folder is used only by a local master.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="papyra-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
