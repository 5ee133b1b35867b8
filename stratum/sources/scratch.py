"""Intermediate tables in the folder that all executors share.

The folder is the session's ``spark.checkpoint.dir``. Only where that is unset and Spark runs in one local
process (tests, a laptop) a local folder is used; a cluster without it is refused. Tables written here survive the loss of executors, and reading them back cuts the lineage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from stratum.sources import files

_CONF = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(_CONF, None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {_CONF} to a folder that all executors of {master} share")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="stratum-scratch-")
        root = _local_folders[app]
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below a folder of this application."""
    app = spark.sparkContext.applicationId
    path = f"{scratch_root(spark)}/stratum/{app}/{label}-{uuid.uuid4().hex[:12]}"
    if _written.get() is not None:
        _written.get().append(path)
    return path


@contextmanager
def dropped_after(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables that the block makes when it ends; no lazy DataFrame may outlive it."""
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        for path in paths:
            files.delete(spark, path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a query that runs in the block has shuffled leaves the disks when the query ends.

    Otherwise it stays until a garbage collection of the driver finds its plan gone, so that the shuffles of a whole run
    add up. A DataFrame that is run once more shuffles once more.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write a DataFrame once as parquet and return a DataFrame that reads it.

    ``path`` is a folder that the caller has taken before, for a table that outlives the block it is written in.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, label)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_all(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once nothing reads them any more."""
    files.delete(spark, f"{scratch_root(spark)}/stratum/{spark.sparkContext.applicationId}")
