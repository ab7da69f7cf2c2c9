"""Shared working folder: tables written once so that they are not recomputed.

A written table cuts the lineage, survives the loss of any executor, and has a
size that can be checked before anything is broadcast.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or the checkpoint folder already set.

    Only a local master may run without either; it then gets a temporary folder,
    once per session. On a cluster every executor must see the folder, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="velomart-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def working_path(spark: SparkSession, name: str) -> str:
    """The same for what is deleted at the end of a ``scope``, if one is open."""
    path = fresh_path(spark, name)
    if (working := _scope.get()) is not None:
        working.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    """The file system of a path and the path as it knows it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, wherever Spark can write one."""
    files, there = _file_system(spark, path)
    files.delete(there, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, there = _file_system(spark, path)
    return files.exists(there)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder."""
    files, there = _file_system(spark, path)
    return files.getContentSummary(there).getLength()


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    files, there = _file_system(spark, path)
    files.create(there, True).close()


class Tables:
    """Written tables of one computation, deleted once nothing reads them any more.

    Writing a name again replaces its table: the earlier one may be read while the new
    one is written, and is deleted then. As a context, all that is left goes at its end;
    a result that is still to be read belongs to ``materialize``.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                remove(self.spark, self.paths.pop(name))

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *failure) -> None:
        self.drop(*list(self.paths))


_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scope", default=None)


#: Whether a query's shuffle files go when it ends; else they stay until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, each query's shuffle files go when it ends, unless the session says if they do."""
    if spark.conf.get(_CLEANUP, None) is not None:
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Within it, tables of ``materialize`` are working tables: all are deleted at its end.

    For jobs whose results are written elsewhere before it ends. Scopes may be nested;
    a table belongs to the innermost. Shuffle files of a query go when it ends, so that
    the disk holds those of one query at a time.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        with shuffles_freed(spark):
            yield
    finally:
        _scope.reset(token)
        for path in paths:
            remove(spark, path)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    The table stays unless a ``scope`` is open, as the caller may read it at any time.
    """
    path = working_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
