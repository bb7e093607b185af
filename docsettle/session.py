"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "docsettle", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job of this package relies on.

    Without ``master`` the launcher (spark-submit) decides where to run. Batches to Python
    are bounded by bytes, since one record of the workbook scan holds a whole file.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for what is planned and run inside; afterwards it is as before."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@lru_cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"docsettle-{application_id}-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary
    folder, which every task of the single machine can reach.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The same rows by way of a table in the shared folder.

    What several results are made of is computed once and survives the loss of executors. The
    shuffles behind it, which nothing reads again, leave the disks as soon as it is written.
    """
    path = shared_dir(df.sparkSession, name)
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path, partitionBy=list(partition_by) or None)
    if (outer := _on_the_way.get()) is not None:
        outer.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Folders of the tables staged since the innermost ``settled`` began.
_on_the_way: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``make()`` as a staged table; tables that it staged on its way, which nothing else may read, leave the shared folder."""
    passing: list[str] = []
    token = _on_the_way.set(passing)
    try:
        rows = make()
    finally:
        _on_the_way.reset(token)
    table = staged(rows, name)
    _delete(rows.sparkSession, passing)
    return table


def discard(table: DataFrame) -> None:
    """Deletes a staged table that was written without partitions and that nothing reads any more."""
    _delete(table.sparkSession, {file.rpartition("/")[0] for file in table.inputFiles()})


def _delete(spark: SparkSession, paths: Iterable[str]) -> None:
    context = spark.sparkContext
    for path in paths:
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
