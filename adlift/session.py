"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SHIPPED: set[str] = set()


def build_session(master: str | None = None, app: str = "adlift", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split skewed joins even where that costs one more shuffle downstream.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Deduplication keeps 30 days of ids; that state belongs off the JVM heap.
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def side_by_side(*jobs: Callable[[], T]) -> list[T]:
    """Run jobs that do not need each other at the same time, so that one fills the tasks another leaves idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(job)) for job in jobs]
        return [job.result() for job in started]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application, so that no node has to have it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="adlift-package-"))
    root, name = os.path.split(package)
    sc.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", root, name))
    _SHIPPED.add(sc.applicationId)


def use_disk_state(spark: SparkSession) -> None:
    """Keep the state of streams off the JVM heap, whoever made the session."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    On a cluster it must be set (``spark.checkpoint.dir``); only a local
    session falls back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="adlift-"))
    return sc.getCheckpointDir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
