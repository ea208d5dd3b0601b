"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "tidings",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings every plan in this package assumes.

    On a cluster ``master`` is left to spark-submit; AQE re-plans joins and
    coalesces/splits shuffle partitions at runtime (skew join on).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate())


RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings the plans rely on; safe on any existing session."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """SQL settings that hold inside (names with ``__`` for dots), as they were before afterwards."""
    before = {k: spark.conf.get(k.replace("__", "."), None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k.replace("__", "."), v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k.replace("__", ".")) if v is None else spark.conf.set(k.replace("__", "."), v)


def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query go when it ends, not when the driver next collects garbage."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


_LOCAL_CHECKPOINT: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent and Spark runs in this one process
    (``local[...]``, as in tests) a temporary folder is used, and removed at
    the end; on a cluster the missing setting is an error.
    """
    global _LOCAL_CHECKPOINT
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
        if _LOCAL_CHECKPOINT is None:
            _LOCAL_CHECKPOINT = tempfile.mkdtemp(prefix="tidings-")
            atexit.register(shutil.rmtree, _LOCAL_CHECKPOINT, ignore_errors=True)
        current = _LOCAL_CHECKPOINT
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, of any file system; the
    writer makes the folder. It is removed when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:      # not stopped yet
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
