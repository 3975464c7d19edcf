"""Where intermediate tables go, and when they go away.

Every table that has to outlive one job is written below the folder the session names in
``spark.checkpoint.dir``, which all executors share. A session that names none gets a
folder in its warehouse, which Spark shares too. Whoever makes such tables collects their
paths and drops them when their owner ends; what is left goes when the program does.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

_collecting: list[list[str]] = []
_used: dict[str, SparkSession] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster-wide folder for intermediate tables."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    named = named or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate").rstrip("/")


def app_folder(spark: SparkSession) -> str:
    """This program's part of the shared folder; it is dropped when the program ends."""
    path = f"{shared_folder(spark)}/sluice/{spark.sparkContext.applicationId}"
    if path not in _used:
        _used[path] = spark
        atexit.register(_drop_quietly, spark, path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{app_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def hand_over(path: str) -> None:
    """Leave a path to the owner that collects paths at the moment, if there is one."""
    if _collecting:
        _collecting[-1].append(path)


def write_out(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back, which cuts its lineage."""
    path = new_path(frame.sparkSession, name)
    hand_over(path)
    with shuffles_dropped(frame.sparkSession):
        frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of each write in the block when the write has ended.

    They would stay until the driver's garbage collector comes by, though the written table
    stands for them. The session has its own setting again after the block.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whichever file system its address names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(target) and system.delete(target, True)


def _system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _system(spark, path)
    return system.exists(target)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    system, target = _system(spark, path)
    if not system.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(target))


def publish(spark: SparkSession, written: str, name: str) -> None:
    """Give a folder that was written aside its name, in one rename; the name must be free."""
    system, target = _system(spark, name)
    if system.exists(target) or not system.rename(spark._jvm.org.apache.hadoop.fs.Path(written), target):
        raise RuntimeError(f"{written} could not become {name}")


def _drop_quietly(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the JVM may be gone by now
        drop_path(spark, path)


@contextmanager
def collecting() -> Iterator[list[str]]:
    """Paths of the tables that :func:`write_out` makes in the block, for an owner to drop."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        _collecting[:] = [held for held in _collecting if held is not paths]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop the tables that :func:`write_out` makes in the block when it ends."""
    with collecting() as paths:
        try:
            yield
        finally:
            for path in paths:
                drop_path(spark, path)


@contextmanager
def handing_up() -> Iterator[None]:
    """Inside :func:`scratch`: leave the tables made in the block to the owner around it."""
    inner = _collecting.pop()
    try:
        with collecting() as paths:
            yield
    finally:
        for path in paths:
            hand_over(path)
        _collecting.append(inner)


@contextmanager
def staging(spark: SparkSession, name: str) -> Iterator[str]:
    """A staging path that is dropped when the block ends, also after an error."""
    path = new_path(spark, name)
    try:
        yield path
    finally:
        drop_path(spark, path)
