"""Session construction and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "flowsieve", **settings: str) -> SparkSession:
    """A session with UTC time and adaptive execution; cluster settings stay as deployed."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Core settings of a running session cannot be changed; this one of our own stands in where none is set.
LOCAL_FOLDER = "flowsieve.local.folder"


def named_folder(spark: SparkSession) -> str | None:
    """The folder in ``spark.checkpoint.dir`` or, where a local session names none, in ``LOCAL_FOLDER``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_FOLDER, None)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach."""
    folder = named_folder(spark)
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
    return folder


def share_checkpoints(spark: SparkSession) -> None:
    """Let Spark's own checkpoints go to the shared folder, unless they have a folder already."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty() and named_folder(spark):
        context.setCheckpointDir(f"{shared_folder(spark).rstrip('/')}/flowsieve/checkpoints")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/flowsieve/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, unique to this call."""
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application has put under ``scratch_path``: for the end of a job, when its
    results are stored elsewhere."""
    _remove(spark, _application_folder(spark))


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def work_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new path under the shared folder for a job's intermediate tables, removed at its end."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        _remove(spark, path)
