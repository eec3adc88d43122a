"""Working tables in the folder that the driver and all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_RUN: ContextVar[str | None] = ContextVar("run", default=None)
#: The folder of a local session without one; it goes when Python ends.
_own: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Where that is unset, a local-mode session (tests) gets a folder of its own;
    a cluster session is refused, since a machine-local folder dies with its machine.
    """
    global _own
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own is None:
        _own = tempfile.TemporaryDirectory(prefix="evidenza-", ignore_cleanup_errors=True)
    return _own.name


def new_path(spark: SparkSession, name: str, kept: bool = False) -> str:
    folder = shared_folder(spark) if kept else _RUN.get() or shared_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, kept: bool = False, compression: str | None = None) -> DataFrame:
    """``df`` written once as Parquet and read again: lineage ends here, and a
    lost executor costs no recomputation of what came before.

    Inside :func:`scratch` the table goes with its run, unless it is ``kept``.
    """
    spark = df.sparkSession
    path = new_path(spark, name, kept)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files that no table needs any more go now, not when the driver next happens to collect garbage."""
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written inside goes at the end.  Results must be written as ``kept``, or be
    used up, before that."""
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield
    finally:
        _RUN.reset(token)
        remove(spark, folder)
