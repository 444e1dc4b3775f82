"""Session settings the package relies on."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ADAPTIVE = "spark.sql.adaptive.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# UTC, so that days, hours and partition values mean the same everywhere. Timestamps as
# 64-bit microseconds, because the older 96-bit form has no min/max statistics and a time
# filter could not skip row groups.
TABLE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app_name: str = "tidegauge", **settings: str) -> SparkSession:
    """Session with the settings this package is tuned for.

    AQE stays on: it coalesces small shuffle partitions, splits skewed joins and writes,
    and turns a join into a broadcast once the measured size of a side allows it.
    Keyword arguments use double underscores for dots, e.g. `spark__master="local[8]"`.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config(map=TABLE_SETTINGS)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_table_settings(spark: SparkSession) -> SparkSession:
    for key, value in TABLE_SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """One session setting for the duration of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below `spark.checkpoint.dir`.

    Every executor has to see it, so a machine-local folder is only used where the whole
    session is one machine (a `local` master) and no folder was named.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidegauge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A `shared_dir` that is removed when the application ends; a lazy result may read it until then."""
    path = shared_dir(spark, purpose)
    atexit.register(remove_dir, spark, path)
    return path


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def remove_dir(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    files, target = file_system(spark, path)
    files.delete(target, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder, in order; none if it does not exist."""
    files, target = file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())
