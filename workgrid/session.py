"""Spark session and shared-storage helpers."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_ENV = "WORKGRID_LOCAL_CHECKPOINT"


def local_session(cpus: int | str = 8, app: str = "workgrid", shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the local bench (one JVM, ``local[cpus]``).

    On a cluster, build the session with the cluster's own settings instead;
    the library only reads ``spark.checkpoint.dir`` from it.
    """
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WORKGRID_DRIVER_MEMORY", "16g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    event_dir = os.environ.get("WORKGRID_EVENT_LOG")
    if event_dir:  # profiling: Spark's event log in a scratch folder
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster's value always wins. Only a local session (one process, as
    in tests) without one gets a scratch folder; on a cluster a missing value
    is an error, because executors would write to their own disks.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = os.environ.get(_LOCAL_CHECKPOINT_ENV) or tempfile.mkdtemp(prefix="workgrid-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return spark.conf.get("spark.checkpoint.dir")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "workgrid", *parts, uuid.uuid4().hex[:12]])


#: Removes a query's shuffle files when it ends; they would stay until the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dropped_shuffles(spark: SparkSession):
    """Inside, a query that ends leaves no shuffle files, for results that are written and read from there."""
    return settings(spark, {SHUFFLE_CLEANUP: "true"})
