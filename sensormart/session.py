"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "sensormart", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="sensormart-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, in the cluster's shared folder.

    The folder is ``spark.checkpoint.dir``. Only a local session may fall back
    to a temporary folder: on a cluster other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    app = spark.conf.get("spark.app.id", "app")
    return f"{base.rstrip('/')}/sensormart/{app}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it wants it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


#: Copies written inside each of the open ``scratch`` blocks, the innermost last.
_written: contextvars.ContextVar[tuple[list, ...]] = contextvars.ContextVar("written", default=())


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Remove the copies that the block has written when it ends.

    For steps that leave nothing lazy behind: their result lies elsewhere, or is kept,
    and then belongs to the block around this one, if there is one. Threads
    the block starts are not followed; they inherit the list by ``copy_context``.
    """
    copies: list = []
    token = _written.set((*_written.get(), copies))
    try:
        yield
    finally:
        _written.reset(token)
        for spark, path in copies:
            files, target = file_system(spark, path)
            files.delete(target, True)


def materialise(df: DataFrame, name: str, spark: SparkSession | None = None, keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and continue from the copy.

    Used where a result feeds several later steps, or where recomputing it could
    give other values (row slots after range sampling). Losing an executor then
    costs a re-read, not a recomputation. ``spark`` reads the copy in another
    session than the one of ``df``. ``keep``: the innermost ``scratch`` block leaves the
    copy to the block around it.
    """
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    blocks = _written.get()[:-1] if keep else _written.get()
    if blocks:
        blocks[-1].append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
