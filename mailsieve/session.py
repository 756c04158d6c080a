"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import cache
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

T = TypeVar("T")
R = TypeVar("R")

# Settings that hold for any data size; parallelism is left to the cluster.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Let AQE swap a sort-merge join for a hash join when every build-side
    # partition was measured to be small: the wide side is then not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "mailsieve",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="mailsieve-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables; removed when Python ends."""
    folder = f"{shared_folder(spark)}/mailsieve/{spark.sparkContext.applicationId}"
    _remove_at_exit(folder)
    return folder


@cache
def _remove_at_exit(folder: str) -> None:
    # Registered after the context's own hook, so the context is still there.
    atexit.register(_remove, folder)


def _remove(folder: str) -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        with contextlib.suppress(Exception):  # the application ends in any case
            remove_folder(spark, folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application. Unread results go with them."""
    remove_folder(spark, run_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the run's folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str, **options) -> DataFrame:
    """Write ``frame`` to a fresh parquet table in the shared folder and read it back.

    Cuts the lineage at a point that outlives the executors. ``options`` go to the writer.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def importable_by_workers(spark: SparkSession) -> None:
    """Let Python workers import this package, from wherever the session was started."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in paths:
        paths.insert(0, root)
    env["PYTHONPATH"] = os.pathsep.join(paths)


def side_by_side(
    spark: SparkSession, work: Callable[[T], R], items: Sequence[T], threads: int = 4
) -> list[R]:
    """Run independent Spark work for each item, several at a time, results in order.

    One small job after another leaves a cluster idle between them.
    """
    with ThreadPool(max(1, min(threads, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items)

