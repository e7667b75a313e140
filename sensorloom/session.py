"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_SCOPE: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch_scope", default=None)


def build_session(app: str = "sensorloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators rely on.

    UTC keeps event time comparable between stages; AQE re-plans joins and
    coalesces shuffles at run time. ``conf`` keys use ``_`` for ``.`` so that
    ``spark_sql_shuffle_partitions=8`` reads naturally.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), str(value))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    It must be visible to every executor, so a machine-local folder is made
    only for a local master, and only when the setting is missing.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="sensorloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _scratch_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/sensorloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path of this application below :func:`checkpoint_root`."""
    return f"{_SCOPE.get() or _scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if it is there, in whatever store holds it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """What is written with :func:`scratch_path` inside goes when the block ends.

    For work that repeats without end, such as the micro-batches of a stream. No frame built on
    scratch tables of the block may be read behind it.
    """
    folder = scratch_path(spark, "scope")
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        delete_folder(spark, folder)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote with :func:`scratch_path`.

    Call it when no frame built on scratch tables is needed any more.
    """
    delete_folder(spark, _scratch_folder(spark))


def write_scratch(df, name: str):
    """Write ``df`` to the shared folder and read it back, cutting its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
