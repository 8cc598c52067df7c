"""Folders of the file system that Spark itself uses, local or distributed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end_with_job(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a table that is written meanwhile is of no more use when it is there.

    The files would otherwise stay until the driver happens to collect its garbage, beside those of
    later steps.
    """
    before = spark.conf.get(_CLEANUP_SETTING, None)
    spark.conf.set(_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_SETTING)
        else:
            spark.conf.set(_CLEANUP_SETTING, before)


@cache
def _own_folder() -> str:
    """A folder of this process, for local sessions without a shared one."""
    path = tempfile.mkdtemp(prefix="stratamart-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with everything in it."""
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches a glob pattern."""
    return bool(matching(spark, pattern))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a glob pattern."""
    fs, target = _resolve(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(target) or []]


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none if there is no such folder."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def move(spark: SparkSession, path: str, target: str) -> None:
    """Move a file to a place of the same file system where nothing is yet; folders are made."""
    fs, source = _resolve(spark, path)
    _, place = _resolve(spark, target)
    fs.mkdirs(place.getParent())
    if not fs.rename(source, place):
        raise OSError(f"{path} could not be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all."""
    fs, target = _resolve(spark, path)
    _, part = _resolve(spark, f"{path}.part")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(target, False)
    fs.rename(part, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """What a small file holds, or nothing if there is none."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that all executors of the session can reach."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = _own_folder()
    return f"{base.rstrip('/')}/stratamart/{name}-{uuid.uuid4().hex}"
