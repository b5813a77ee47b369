"""Session helpers: a local session for tests and benches, and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for one machine. On a cluster, use the session the cluster gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("seawarden")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. A temporary folder is used
    only for a local master, where driver and executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    """A path and its file system, whatever store it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, none if it is not there."""
    store, place = _path(spark, path)
    if not store.exists(place):
        return []
    return [status.getPath().getName() for status in store.listStatus(place) if status.isDirectory()]


def is_there(spark: SparkSession, path: str) -> bool:
    store, place = _path(spark, path)
    return store.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    store, place = _path(spark, path)
    store.delete(place, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, for functions that run in Python there."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
