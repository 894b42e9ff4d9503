"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "veilcount", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; a cluster submit may override any of them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master without that setting gets a temporary
    folder of its own, because there the driver's disk is every executor's disk.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-veilcount-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/veilcount/{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a work folder that nothing reads any more, through its Hadoop file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that begin inside delete their shuffle files as they end; else these stay until the driver's JVM happens to
    collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
